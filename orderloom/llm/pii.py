"""Personal data in text by weak supervision; DataFrame functions only.

Four kinds are found by fixed patterns and checks: e-mail and IP addresses, card and phone numbers. Further
kinds have candidates only, and labelers that vote on them: patterns of a stricter shape, gazetteers, and words around
the candidate. Nobody labels anything. Expectation-maximisation over the counts of voting patterns estimates how often
each labeler is right, per kind, and how likely each pattern is personal data. A span classifier is fitted to these
probabilities on the votes and the look of the spans, and decides every candidate.

Spark counts voting patterns and looks over the whole corpus; the driver sees one row for each combination, whose number
does not grow with the corpus. The fitted weights go back as a literal map, and spans are decided inside the row
of their document: no text is shuffled.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.session import stage

# The base kinds in the order in which they are listed, and their patterns. Groups that need no second
# try are possessive, and starts inside a run that has failed are passed over, so that long texts take linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# Candidates of the kinds that are voted on
VOTED = {
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}",
    "local_phone": r"(?<![0-9+.(-])\(?[0-9]{2,4}\)?(?:[ .-]\(?[0-9]{2,4}\)?){2,4}(?![0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme)\.? [A-Z][a-z]+(?: [A-Z][a-z]+)?",
}
RANK = {kind: rank for rank, kind in enumerate([*BASE, *VOTED])}

# What the labelers look for: a strict shape, a gazetteer, words before the candidate, and signs of something else
STRICT = {
    "secret": r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+)$",
    "local_phone": r"^\(?0?[1-9][0-9]{1,3}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{2,4}",
    "national_id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}(?:0[2-9]|[1-8][0-9]|9[0-8])",
    "name": r" [A-Z][a-z]+ [A-Z][a-z]+$",
}
GAZETTEER = {
    "secret": r"^(?:sk-|pk-|ghp_|gho_|AKIA|ASIA|AIza|xox[abp]-|glpat-|eyJ)",
    "local_phone": r"^\(?(?:0[1-9]|2[0-9]{2}|[3-9][0-9]{2})",
    "national_id": r"^(?:0|1|2|3|4|5)",
    "iban": r"^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)",
    "name": r"(?i) (?:anna|carlos|hans|james|jean|john|juan|maria|marie|mary|michael|paul|peter|robert|sarah|thomas)\b",
}
CONTEXT = {
    "secret": r"(?i)(?:token|secret|key|passw|pwd|auth|bearer|credential|api)[^A-Za-z0-9]{0,12}$",
    "local_phone": r"(?i)(?:tel|phone|call|fax|mobile|cell|contact)[^0-9]{0,12}$",
    "national_id": r"(?i)(?:ssn|social|security|tax|id)[^0-9]{0,16}$",
    "iban": r"(?i)(?:iban|bank|account|konto|cuenta|compte)[^A-Za-z0-9]{0,16}$",
    "name": r"(?i)(?:dear|by|from|contact|patient|with|client|signed|to)[^A-Za-z0-9]{0,6}$",
}
AGAINST = r"(?i)(?:sha[0-9]*|md5|commit|hash|checksum|isbn|version|https?:/[^ ]*|href|src|order|invoice)[^A-Za-z0-9]{0,6}$"
LABELERS = ("strict", "gazetteer", "context", "against")
BEFORE = 32  # code points before a candidate that labelers see

SUMMED = 64  # numbers that are summed up one by one; longer lists are cut into lists of so many


def _sums_one_by_one(numbers: Column) -> Column:
    def step(done: Column, number: Column) -> Column:
        return F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + number))

    return F.aggregate(numbers, F.from_json(F.lit("[]"), "array<int>"), step)


def running_sums(numbers: Column, depth: int = 3) -> Column:
    """The running sums of a list, in time that grows with its length: sums inside short lists, and running sums of their
    totals on top, ``depth`` times over."""
    if not depth:
        return _sums_one_by_one(numbers)
    cuts = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / SUMMED).cast("int"))
    inner = F.transform(cuts, lambda k: _sums_one_by_one(F.slice(numbers, k * SUMMED + 1, F.lit(SUMMED))))

    def on_top(lists: Column) -> Column:
        above = running_sums(F.transform(lists, lambda sums: F.element_at(sums, -1)), depth - 1)
        raised = F.zip_with(lists, above, lambda sums, total: F.transform(sums, lambda x: x + total - F.element_at(sums, -1)))
        return F.flatten(raised)

    # the lists are an element of a list, so that they are made once however often they are used
    long = F.element_at(F.transform(F.array(inner), on_top), 1)
    return F.when(F.size(numbers) <= SUMMED, _sums_one_by_one(numbers)).otherwise(long)


def located(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches of a pattern as (start, end, body), in code points.

    A regular expression function tells matches or what lies between them, and both together tell the places: a match
    ends where all matches and gaps up to it end.
    """
    bodies = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(found: Column) -> Column:
        steps = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.char_length(m) + F.char_length(g))
        return F.zip_with(
            running_sums(steps), found, lambda end, m: F.struct((end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("body"))
        )

    return F.element_at(F.transform(F.array(bodies), placed), 1)


def _luhn(digits: Column) -> Column:
    def worth(place: Column) -> Column:
        digit = F.substring(digits, -place, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(place % 2 == 0, doubled).otherwise(digit)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.char_length(digits)), worth), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str, body: Column) -> Column:
    digits = F.regexp_replace(body, "[^0-9]", "")
    if kind == "ip":
        return body.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")
    if kind == "card":
        return F.when(F.char_length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The valid matches of a base kind. A match that fails its check is dropped, and nothing inside it is tried."""
    possible = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9][ -]?[0-9]"), "phone": text.contains("+")}
    found = F.when(possible[kind], located(text, BASE[kind]))
    return F.coalesce(F.filter(found, lambda s: _valid(kind, s["body"])), F.from_json(F.lit("[]"), "array<struct<start:int,end:int,body:string>>"))


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(RANK[kind]).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def candidates(text: Column, base: Column, kind: str) -> Column:
    """Candidates of a voted kind that meet no base span: (start, end, kind, votes, look). Votes are a letter a labeler:
    y, n, or - where it has nothing to say."""
    possible = text.rlike("[0-9]") if kind != "name" else text.rlike("(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme)")
    found = F.coalesce(F.when(possible, located(text, VOTED[kind])), F.from_json(F.lit("[]"), "array<struct<start:int,end:int,body:string>>"))
    if kind == "secret":  # letters alone are words, digits alone are numbers
        found = F.filter(found, lambda s: s["body"].rlike("[0-9]") & s["body"].rlike("[A-Za-z]"))
    free = F.filter(found, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def vote(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - BEFORE, F.lit(0)) + 1, F.least(s["start"], F.lit(BEFORE)))
        said = [
            F.when(s["body"].rlike(STRICT[kind]), "y").otherwise("n"),
            F.when(s["body"].rlike(GAZETTEER[kind]), "y").otherwise("-"),
            F.when(before.rlike(CONTEXT[kind]), "y").otherwise("-"),
            F.when(before.rlike(AGAINST), "n").otherwise("-"),
        ]
        size = F.least(F.floor(F.log2(F.char_length(s["body"]).cast("double"))), F.lit(9)).cast("string")
        mixed = F.concat(*[F.when(s["body"].rlike(p), F.lit(c)).otherwise("") for p, c in (("[a-z]", "a"), ("[A-Z]", "A"), ("[0-9]", "0"), ("[^A-Za-z0-9]", "."))])
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.concat(*said).alias("votes"), F.concat_ws("/", size, mixed).alias("look"))

    return F.transform(free, vote)


def _span_rows(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the number of base spans by kind, all of them, and all candidates; no texts."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", *[base_spans(F.col("text"), kind).alias(f"_{kind}") for kind in BASE])
    rows = rows.withColumn("_base", F.concat(*[_listed(kind, F.col(f"_{kind}")) for kind in BASE]))
    sizes = [F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in BASE]
    voted = F.concat(*[candidates(F.col("text"), F.col("_base"), kind) for kind in VOTED]).alias("_voted")
    return rows.select("doc_id", *sizes, "_base", voted)


def expectation_maximisation(patterns: dict[str, float], rounds: int = 60) -> dict[str, float]:
    """The probability of each voting pattern that its span is personal data, from how often each pattern occurs.

    Labelers vote independently given the truth. Each starts out as better than chance, which settles what the two
    classes mean, and pseudo-counts keep it from certainty.
    """
    places = range(len(LABELERS))
    prior = 0.5
    yes = [{"y": 0.6, "n": 0.1, "-": 0.3} for _ in places]
    no = [{"y": 0.1, "n": 0.6, "-": 0.3} for _ in places]
    posterior: dict[str, float] = {}
    for _ in range(rounds):
        for pattern in patterns:
            p = prior * math.prod(yes[k][v] for k, v in enumerate(pattern))
            q = (1 - prior) * math.prod(no[k][v] for k, v in enumerate(pattern))
            posterior[pattern] = p / (p + q)
        total = sum(patterns.values())
        prior = (1 + sum(n * posterior[v] for v, n in patterns.items())) / (2 + total)
        for table, weight, start in ((yes, lambda v: posterior[v], (0.6, 0.1)), (no, lambda v: 1 - posterior[v], (0.1, 0.6))):
            for k in places:
                counts = {"y": 4 * start[0], "n": 4 * start[1], "-": 4 * 0.3}
                for pattern, n in patterns.items():
                    counts[pattern[k]] += n * weight(pattern)
                mass = sum(counts.values())
                table[k] = {v: c / mass for v, c in counts.items()}
    return posterior


def fit_classifier(counts: list[tuple[str, str, str, int]], steps: int = 200, rate: float = 0.5, l2: float = 1e-3) -> dict[str, float]:
    """Weights of a logistic regression over kinds, votes and looks, fitted to the probabilities of the voting patterns.

    ``counts`` has (kind, votes, look, number of spans).
    """
    by_kind: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for kind, votes, _, n in counts:
        by_kind[kind][votes] += n
    truth = {kind: expectation_maximisation(patterns) for kind, patterns in by_kind.items()}
    rows = [(span_features(kind, votes, look), truth[kind][votes], math.sqrt(n)) for kind, votes, look, n in counts]
    weights: dict[str, float] = defaultdict(float)
    seen: dict[str, float] = defaultdict(lambda: 1e-6)
    mass = sum(n for _, _, n in rows) or 1.0
    for _ in range(steps):
        grad: dict[str, float] = defaultdict(float)
        for names, goal, n in rows:
            gap = n / mass * (goal - 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[x] for x in names))))))
            for name in names:
                grad[name] += gap
        for name, value in grad.items():
            value -= l2 * weights[name] / max(len(rows), 1)
            seen[name] += value * value
            weights[name] += rate * value / math.sqrt(seen[name])
    return dict(weights)


def span_features(kind: str, votes: str, look: str) -> list[str]:
    return [kind, *[f"{kind}/{labeler}={vote}" for labeler, vote in zip(LABELERS, votes)], f"{kind}/{look}"]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Starts and ends count code points, ends are exclusive. Null texts are empty: no spans, and the digest of
    nothing. Repeated rows are treated alike, null identifiers stay null. Other columns are not looked at. An empty table gives an empty result.
    """
    # texts are searched once: the votes are counted and judged on the staged spans
    rows = stage(docs.sparkSession, _span_rows(docs), "spans")
    counts = rows.select(F.explode("_voted").alias("s")).groupBy("s.kind", "s.votes", "s.look").count().collect()
    weights = fit_classifier(sorted((r["kind"], r["votes"], r["look"], r["count"]) for r in counts))
    if weights:
        table = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair])

        def weight(name: Column) -> Column:
            return F.coalesce(F.try_element_at(table, name), F.lit(0.0))

        def score(s: Column) -> Column:
            total = weight(s["kind"]) + weight(F.concat_ws("/", s["kind"], s["look"]))
            for k, labeler in enumerate(LABELERS):
                total = total + weight(F.concat(s["kind"], F.lit(f"/{labeler}="), F.substring(s["votes"], k + 1, 1)))
            return total

        accepted = F.filter("_voted", lambda s: score(s) >= 0)
    else:
        accepted = F.col("_voted")
    rank = F.create_map(*[F.lit(x) for pair in RANK.items() for x in pair])
    added = F.transform(
        accepted, lambda s: F.struct(s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    rows = rows.withColumn("_added", added)
    return rows.select(
        "doc_id",
        *[f"n_{kind}" for kind in BASE],
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.concat("_base", "_added")).alias("spans"),
        F.size("_added").cast("long").alias("n_added"),
    )
