"""The registered corpus queries against plain versions, and every operator on awkward tables."""

import binascii
import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import brute
import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from orderloom.llm import (
    decontamination, exact_dedup, html_extract, ngram_join, packing, phrase_dedup, pii, quality, repeats, sharding, suffix_dedup,
)

SF_DIR = "/root/testdata/sf0.001"
TOKENIZER = corpus_pipeline.tokenizer_path()
# names that operators use inside, and must not trip over
CLASHES = "_id, node, anchor, digest, check, run, keep_id, kept, shard, slot, rank, length, _block, _gone, start, place, ranges, votes"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES.split(", "))

LINE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix a potion of bright blue light in the old tower "
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, "Word"), (6, "one two three"), (7, LINE), (8, LINE.upper()), (9, LINE),
    (9, LINE), (10, LINE * 3), (11, "x" * 350), (12, "x" * 99), (13, "ab" * 400), (14, "é😀ß " * 120), (15, "a\0b " * 60),
    (16, LINE * 400), (17, "mail a.b@c.example.com or +1 (555) 123-4567, 4111 1111 1111 1111 and 10.0.0.256 at 10.0.0.1.2.3.4.5."),
    (18, "a@b.c_d@e.f x@y +12345678 +123456789 12345678901234567890 0000000000000 300.1.1.1"), (19, "token = \"" + "a1b2c3d4" * 5 + "\""),
    (20, "start " + LINE + " end"), (21, LINE[:60]), (22, "one two three"), (None, "no identifier " * 30), (None, LINE),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(d, t, None if d == 4 else "en", f"s{(d or 0) % 3}", len(t or "")) + (None,) * len(CLASHES.split(",")) for d, t in AWKWARD]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def given(name="documents"):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def documents():
    return [(r["doc_id"], r["text"]) for r in given()]


def by_id(rows, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in rows}


def run(name, spark):
    return driver.queries()[name](spark, SF_DIR).collect()


def test_repeated_bytes(spark):
    assert by_id(run("op1_suffix_dedup", spark), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeated_bytes(documents())


def test_repeated_phrases(spark):
    assert by_id(run("op2_phrase_dedup", spark), "n_words", "n_removed", "kept_sha256") == brute.repeated_phrases(documents())


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats_on_awkward_rows(spark, awkward, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    # two rows without an identifier are one document to the operator, and two texts to the plain version
    rows = awkward.where("doc_id IS NOT NULL")
    pairs = [r for r in AWKWARD if r[0] is not None]
    found = suffix_dedup.remove_repeated_bytes(rows, with_text=True).collect()
    assert len(found) == len(pairs)
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeated_bytes(pairs)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found)
    found = phrase_dedup.remove_repeated_phrases(rows).collect()
    assert by_id(found, "n_words", "n_removed", "kept_sha256") == brute.repeated_phrases(pairs)
    assert len(suffix_dedup.remove_repeated_bytes(awkward).collect()) == len(AWKWARD)
    assert len(phrase_dedup.remove_repeated_phrases(awkward).collect()) == len(AWKWARD)


def test_crowded_anchors_are_halved(spark, monkeypatch):
    draw = random.Random(4)
    passage = " ".join(f"passage{k}" for k in range(24))
    pairs = []
    for doc in range(90):
        before, after = (" ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(draw.randint(0, 16))) for _ in range(2))
        pairs.append((doc, f"{before} {passage} {after} {passage if doc % 7 == 0 else ''}"))
    sizes, first_places = [], repeats._first_places

    def recorded(segments, finder, parts):
        sizes.append(segments.groupBy("anchor").count().agg(F.max("count")).first()[0] or 0)
        return first_places(segments, finder, parts)

    monkeypatch.setattr(repeats, "HOT_SEGMENTS", 4)
    monkeypatch.setattr(repeats, "_first_places", recorded)
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    found = suffix_dedup.remove_repeated_bytes(docs).collect()
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeated_bytes(pairs)
    assert len(sizes) == 2 and max(sizes) <= 4
    sizes.clear()
    found = phrase_dedup.remove_repeated_phrases(docs).collect()
    assert by_id(found, "n_words", "n_removed", "kept_sha256") == brute.repeated_phrases(pairs)
    assert len(sizes) == 2 and max(sizes) <= 4


def test_documents_stay_where_crowded_segments_are_cut(spark, monkeypatch):
    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefgh", k=300)) for _ in range(20)] * 2
    passage = "".join(draw.choices("ijklmnop", k=130))
    texts += ["".join(draw.choices("abcdefgh", k=60)) + passage + "".join(draw.choices("abcdefgh", k=60)) for _ in range(40)]
    plans = []

    def recorded(spark, df, label, *options, stage=repeats.stage):
        if label == "halves":
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return stage(spark, df, label, *options)

    monkeypatch.setattr(repeats, "HOT_SEGMENTS", 30)
    monkeypatch.setattr(repeats, "stage", recorded)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = suffix_dedup.remove_repeated_bytes(docs).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeated_bytes(list(enumerate(texts)))
    assert "SortMergeJoin [anchor" in plans[0] and "Join [_id" not in plans[0]


def test_near_duplicates(spark):
    assert by_id(run("op4_ngram_join", spark), "n_shingles", "component_id") == brute.near_duplicates(documents())


def test_near_duplicates_on_awkward_rows(spark, awkward):
    found = ngram_join.near_duplicates(awkward).collect()
    assert len(found) == len(AWKWARD)
    known = [r for r in AWKWARD if r[0] is not None]
    assert by_id([r for r in found if r["doc_id"] is not None], "n_shingles", "component_id") == brute.near_duplicates(known)
    assert sorted((r["component_id"] is None, r["component_id"]) for r in found if r["doc_id"] is None) == [(False, 7), (True, None)]
    left = {r["doc_id"] for r in ngram_join.keep_one_of_each(awkward).collect()}
    assert {1, 2, 3, 4, 6, 7} <= left and not left & {5, 8, 9, 22}


def test_a_group_of_near_copies_needs_no_direct_links(spark):
    """A chain in which only neighbours link is one component, and a group larger than a list is not lost."""
    words = [f"w{k}" for k in range(400)]
    chain = [(k, " ".join(words[4 * k : 4 * k + 100])) for k in range(60)]
    chain += [(100 + k, " ".join(words[:50] + [f"edit{k}"] + words[50:90])) for k in range(120)]
    docs = spark.createDataFrame([(d, t) for d, t in chain], "doc_id long, text string")
    assert by_id(ngram_join.near_duplicates(docs).collect(), "n_shingles", "component_id") == brute.near_duplicates(chain)


def check_packing(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = Counter()
    for d, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 2048):
            piece = np.array(ids[k : k + 2048], dtype="<u4").tobytes()
            expected[d, k, len(piece) // 4, binascii.crc32(piece), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return len(sequences), -(-sum(r["length"] for r in rows) // 2048)


def test_packing(spark, awkward):
    used, least = check_packing(documents(), run("op5_packing", spark))
    assert used <= 1.01 * least + 1
    check_packing(AWKWARD, packing.pack_documents(awkward, TOKENIZER).collect())
    ids = packing.pack_documents(awkward, TOKENIZER, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in ids)


def test_personal_data(spark, awkward):
    for pairs, rows in ((documents(), run("op6_pii", spark)), (AWKWARD, pii.find_personal_data(awkward).collect())):
        expected = Counter((d, *brute.base_spans(t)[0]) for d, t in pairs)
        assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in rows) == expected
        base = defaultdict(set)
        for d, t in pairs:
            base[d] |= set(brute.base_spans(t)[1])
        for r in rows:
            spans = r["spans"].split(",") if r["spans"] else []
            places = [(int(a), pii.RANK[k], int(b)) for k, a, b in (s.split(":") for s in spans)]
            assert places == sorted(places) and len(spans) == r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] + r["n_added"]
            if len([d for d, _ in pairs if d == r["doc_id"]]) == 1:
                assert base[r["doc_id"]] <= set(spans)
    secret = [r for r in rows if r["doc_id"] == 19][0]
    assert secret["spans"] == "secret:9:49"


def test_personal_data_in_long_runs(spark):
    """Texts on which naive patterns take quadratic time or exhaust the stack."""
    texts = ["a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1 " * 50_000, "1 " * 100_000, "a@b" + ".c" * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find_personal_data(docs).collect()
    # known without a naive pattern, which takes minutes: 25,000 addresses of four ones, and one mail address
    places = {2: [f"ip:{8 * k}:{8 * k + 7}" for k in range(25_000)], 5: ["email:0:200003"]}
    expected = {k: (int(k == 5), 25_000 * int(k == 2), 0, 0, hashlib.sha256(",".join(places.get(k, [])).encode()).hexdigest()) for k in range(len(texts))}
    assert by_id(rows, "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == expected


def test_many_mails_in_one_text(spark):
    text = "".join(f"user{k}@host{k % 7}.example.org ß😀 " for k in range(16_000))
    docs = spark.createDataFrame([(1, text), (2, text[:2000]), (3, "no mail")], "doc_id long, text string")
    found = by_id(pii.find_personal_data(docs).collect(), "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert found == {d: brute.base_spans(t)[0] for d, t in ((1, text), (2, text[:2000]), (3, "no mail"))} and found[1][0] == 16_000


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4096, 4097, 5000])
def test_running_sums(spark, n):
    from pyspark.sql import functions as F

    row = spark.range(1).select(pii.running_sums(F.transform(F.slice(F.sequence(F.lit(1), F.lit(max(n, 1))), 1, n), lambda x: x.cast("int"))).alias("s")).first()
    assert row.s == np.cumsum(np.arange(1, n + 1)).tolist()


def thue_morse(letters, doublings=10):
    """A word and the same with its two letters swapped: equal under any polynomial hash modulo 2^64."""
    one, two = letters
    for _ in range(doublings):
        one, two = one + two, two + one
    return one, two


def test_words_of_a_pattern_are_told_apart(spark):
    words = list(thue_morse("ab")) + list(thue_morse(("ab", "ba"), 11)) + [w[:64] for w in thue_morse("ab")] + [w[:40] for w in thue_morse("ab")]
    docs = [(k, f"{w} " + " ".join(f"w{i}" for i in range(3))) for k, w in enumerate(words)]
    docs += [(100 + k, f"{w} " + " ".join(f"v{i}" for i in range(12))) for k, w in enumerate(words)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    assert by_id(ngram_join.near_duplicates(rows).collect(), "n_shingles", "component_id") == brute.near_duplicates(docs)
    assert by_id(phrase_dedup.remove_repeated_phrases(rows).collect(), "n_words", "n_removed", "kept_sha256") == brute.repeated_phrases(docs)
    one, two = thue_morse("ab")
    items = spark.createDataFrame([(1, one), (2, LINE)], "item_id long, text string")
    leaks = decontamination.benchmark_leaks(spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string"), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in leaks} == {(1, 1)}


def test_ids_of_words_whose_letters_end_in_marks():
    """Every code point before signs, as it is and after a letter, against the tokenizer itself."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(TOKENIZER), packing.WordIds(TOKENIZER)
    points = [c for c in map(chr, range(0x21, 0x30000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["BİRLİĞİ, TBMM'nin TEKLİFİ. EĞİTİMİ:"]
    texts += [" ".join(f"{c}{signs} a{c}{signs} {c.upper()}{c}{signs}x" for c in points[k : k + 500]) for k in range(0, len(points), 500) for signs in (",", ".)")]
    ids, firsts = encoder.encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[firsts[k] : firsts[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, k


def test_results_equal_sql(spark):
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    for name, sql in ((n, s) for n, s in driver.oracle_sql().items() if n.startswith("op")):
        cursor = connection.execute(sql)
        labels = [d[0] for d in cursor.description]
        theirs = Counter(tuple(sorted(zip(labels, row))) for row in cursor.fetchall())
        assert Counter(tuple(sorted(r.asDict().items())) for r in run(name, spark)) == theirs and theirs


def test_exact_duplicates_on_awkward_rows(spark, awkward):
    for largest in (True, False):
        rows = exact_dedup.exact_duplicates(awkward, largest=largest).collect()
        groups = defaultdict(list)
        for d, t in AWKWARD:
            groups[t or ""].append(d)
        stays = {t: (max if largest else min)([d for d in ids if d is not None], default=None) for t, ids in groups.items()}
        expected = Counter(
            (d, stays[t or ""], len(groups[t or ""]), d == stays[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for d, t in AWKWARD
        )
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows) == expected
    left = exact_dedup.drop_exact_duplicates(awkward)
    assert left.columns == awkward.columns
    assert not {r["doc_id"] for r in left.collect()} & {1, 6, 7}


@pytest.mark.parametrize("shards", [1, 16, 100])
def test_shards(spark, awkward, shards):
    rows = sharding.shard_documents(awkward, shards).collect()
    expected = Counter((d, len((t or "").encode()) + 1, binascii.crc32((t or "").encode())) for d, t in AWKWARD)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "key" and 0 <= r["shard"] < shards and r["grown_shard"] in (r["shard"], shards)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_equal_a_plain_walk(spark):
    from pyspark.sql import functions as F

    def walk(key, shards):
        seed = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        shard, following, step = -1, 0, 0
        while following < shards:
            step += 1
            drawn = xxhash.xxh64_intdigest(step.to_bytes(4, "little"), seed) >> 33
            shard, following = following, int((following + 1) / ((drawn + 1) / 2**31))
        return shard

    counts = (1, 2, 16, 17, 1000)
    keys = spark.createDataFrame([(k,) for k in [*range(500), -1, -(2**63), 2**63 - 1]], "k long")
    for r in keys.select("k", *[sharding.jump_shard(F.col("k"), n).alias(str(n)) for n in counts]).collect():
        assert [r[str(n)] for n in counts] == [walk(r["k"], n) for n in counts]


def test_shards_are_even_and_move_little(spark):
    from pyspark.sql import functions as F

    keys = spark.range(40_000).select(sharding.jump_shard(F.col("id"), 40).alias("a"), sharding.jump_shard(F.col("id"), 41).alias("b"))
    rows = keys.groupBy("a", "b").count().collect()
    sizes = Counter()
    for r in rows:
        sizes[r["a"]] += r["count"]
        assert r["b"] in (r["a"], 40)
    moved = sum(r["count"] for r in rows if r["b"] == 40)
    assert len(sizes) == 40 and 850 < min(sizes.values()) and max(sizes.values()) < 1150 and 850 < moved < 1100


def test_extraction(spark):
    import html
    import re

    rows = run("op3_html_extract", spark)
    pages = {r["page_id"]: r for r in given("pages")}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        expected = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", article))).split())
        assert (r["text"], r["n_chars"], r["url"]) == (expected, len(expected), pages[r["page_id"]]["url"])
    odd = spark.createDataFrame(
        [(1, None, None, 1), (1, "u", "", 1), (None, "u", "just text &lt; here", 1), (2, "u", "<p>a<p>b<li>c", 1), (3, "u", "<" * 5000, 1), (4, "u", "<div>" * 3000 + "deep", 1)],
        "page_id long, url string, html string, text int",
    )
    assert [r["text"] for r in html_extract.extract_pages(odd).collect()] == ["", "", "just text < here", "a b c", "<" * 5000, "deep"]


def test_quality(spark, awkward, empty):
    big = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    models = quality.train(docs, labels.where("doc_id % 2 = 0"))
    truth = {r["doc_id"]: r for r in labels.where("doc_id % 2 = 1").collect()}
    kept = {r["doc_id"]: r["kept"] for r in quality.score(docs.where("doc_id % 2 = 1"), models).collect() if r["doc_id"] in truth}
    clean = [kept[d] for d, r in truth.items() if d in kept and r["quality"] and not r["toxic"]]
    junk = [kept[d] for d, r in truth.items() if d in kept and not r["quality"]]
    toxic = [kept[d] for d, r in truth.items() if d in kept and r["quality"] and r["toxic"]]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.1 and np.mean(toxic) < 0.25
    assert len(quality.score(awkward, models).collect()) == len(AWKWARD)
    no_labels = spark.createDataFrame([(1, None, None), (None, 1, 0)], "doc_id long, quality long, toxic long")
    assert all(r["kept"] for r in quality.quality_scores(awkward, no_labels).collect())
    assert quality.quality_scores(empty, no_labels).collect() == []


def test_leaks(spark, awkward, empty):
    items = {r["item_id"]: r["text"] for r in given("benchmark")}
    expected = set()
    for d, t in documents():
        words = (t or "").lower().split()
        runs = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for item, text in items.items():
            own = text.lower().split()
            mine = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
            if len(mine & runs) >= 0.5 * len(mine):
                expected.add((d, item))
    assert {(r["doc_id"], r["item_id"]) for r in run("op10_decontamination", spark)} == expected and expected
    odd = spark.createDataFrame([(1, None, 1), (2, " ", 1), (None, LINE, 1), (3, LINE, 1), (3, LINE, 1), (4, "Word", 1)], "item_id long, text string, doc_id int")
    found = Counter((r["doc_id"], r["item_id"]) for r in decontamination.benchmark_leaks(awkward, odd).collect())
    assert {d for d, item in found if item == 3} == {7, 8, 9, 10, 16, 20, None} and found[9, 3] == 4
    assert {d for d, item in found if item == 4} == {4, 5}
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.benchmark_leaks(awkward, odd, shard_bytes=130).collect()} == set(found)
    assert decontamination.benchmark_leaks(awkward, odd.where("false")).collect() == []
    assert decontamination.drop_contaminated(awkward, odd).columns == awkward.columns


def test_leaks_with_signs_around_words(spark):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in given("benchmark")}
    items = {i: t for i, t in items.items() if len(t.split()) >= 8}
    copies = [(i, "### das&&& %%%" + t + "$$$ rehe*** to%%%") for i, t in items.items()]
    copies += [(i, " ".join(f"\u00ab{w}\u201d\u2026" for w in t.split())) for i, t in items.items()]
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    found = Counter((r["doc_id"], r["item_id"]) for r in decontamination.benchmark_leaks(docs, benchmark).collect())
    assert all(found[i, i] == 2 for i in items)
    few = decontamination.benchmark_leaks(docs, benchmark, shard_bytes=5000)
    assert Counter((r["doc_id"], r["item_id"]) for r in few.collect()) == found
    # a short last sentence is not the answer by itself, and a word of signs alone remains a word
    odd = spark.createDataFrame([(1, LINE.strip() + ". Certainly."), (2, "+ - * /")], "item_id long, text string")
    docs = spark.createDataFrame([(1, LINE.strip() + ". Certain1y."), (2, "+ - * /"), (3, "# ## ### ####")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.benchmark_leaks(docs, odd).collect()} == {(1, 1), (2, 2)}


def test_leaks_in_capitals(spark):
    items = {r["item_id"]: r["text"] for r in given("benchmark") if len(r["text"].split()) >= 8}
    items[-1] = "größe straße füße weiß maß spaß gruß fleiß heiß süß außen draußen grüße schließen"  # capitals write ss
    items[-2] = "η οδός του λόγος φως ήλιος κόσμος άνθρωπος ουρανός θάλασσα δρόμος χρόνος"  # a final sigma
    assert any(not t.isascii() for i, t in items.items() if i >= 0)
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = spark.createDataFrame([(i, "before " + t.upper() + " after") for i, t in items.items()], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.benchmark_leaks(docs, benchmark).collect()}
    assert {(i, i) for i in items} <= found


def test_empty_tables(spark, empty):
    benchmark = spark.createDataFrame([(1, LINE)], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    for rows in (
        suffix_dedup.remove_repeated_bytes(empty), phrase_dedup.remove_repeated_phrases(empty), ngram_join.near_duplicates(empty),
        packing.pack_documents(empty, TOKENIZER), pii.find_personal_data(empty), exact_dedup.exact_duplicates(empty),
        sharding.shard_documents(empty), quality.quality_scores(empty, labels), decontamination.benchmark_leaks(empty, benchmark),
        html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")),
    ):
        assert rows.collect() == []


def test_pipeline(spark):
    """Every stage on all that its predecessor kept, against the plain versions."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = dict(documents())
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        rows = step(spark, docs, SF_DIR)
        if name != "packing":
            assert rows.columns == docs.columns
            docs = spark.createDataFrame(rows.collect(), docs.schema)
            kept[name] = {r["doc_id"] for r in docs.collect()}
    good, exact, near, clean = kept.values()
    scored = quality.quality_scores(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert good == {r["doc_id"] for r in scored.collect() if r["kept"]} and len(good) > 0.7 * len(text)
    last = {}
    for d in sorted(good):
        last[text[d]] = d
    assert exact == set(last.values())
    assert near == {d for d, (_, component) in brute.near_duplicates([(d, text[d]) for d in exact]).items() if d == component}
    leaks = {r["doc_id"] for r in run("op10_decontamination", spark)}
    assert clean == near - leaks
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    check_packing([(d, text[d]) for d in clean], packed)


def test_oracle_covers_what_sql_can_say():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
