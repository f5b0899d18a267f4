"""A Merkle manifest of a dataset by nested-struct rollup; the rollup and the proofs are made without joins.

Each row is a leaf, and ``FAN`` consecutive nodes of a source become their hash until one is left. A leaf's rank in its
source is written in digits of base ``FAN``. The rows of a block of ``FAN ** DIGITS`` leaves share all digits but
the last three; those are grouped away one after another, and each grouping nests the structs of the one before. The
shuffle is by block, so that all groupings of a block need just one, and a source with a third of all rows is as many
blocks as it has leaves. The roots of the blocks are the leaves of the next tier, up to one root for each
source, and the roots of the sources are rolled up in the same way.

Proofs come down the same tiers: a block and the siblings above it meet in a grouping by block, the nested structs are
transformed into the siblings on the left and on the right of every node, and exploded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.ordered import keep_places, number_in_order
from orderloom.session import stage

FAN = 16
DIGITS = 3
# The fields of a leaf in their order, the polynomial's multiple that marks rows to tamper with
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_OF = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_hash(values: Sequence[Column]) -> Column:
    """The hash of some values, each written as its UTF-8 length, a colon and itself, or as ``-`` where it is null."""
    texts = [v.cast("string") for v in values]
    return _hash(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _levels(size: Column) -> Column:
    """How often ``size`` nodes are grouped until one is left."""
    return sum((size > F.lit(FAN**k)).cast("int") for k in range(1, 16)) + (size > 1).cast("int")


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda n: n["digest"]), "")


def _tier(nodes: DataFrame, group: str, done: int, payload: Sequence[str]) -> DataFrame:
    """One row for each block of nodes: group, block, levels, digest and the nested ``kids``, three digits deep."""
    digit = [F.floor(F.col("_pos") / FAN**k) % FAN for k in range(DIGITS)]
    rows = nodes.select(
        group, "levels", F.floor(F.col("_pos") / FAN**DIGITS).alias("block"), *[d.alias(f"d{k}") for k, d in enumerate(digit)], "digest", *payload
    )
    rows = rows.repartition(group, "block")
    held = ["digest", *payload]
    for k in range(DIGITS):
        left = [f"d{j}" for j in reversed(range(k + 1, DIGITS))]
        kids = F.array_sort(F.collect_list(F.struct(f"d{k}", *held)))
        rows = rows.groupBy(group, "levels", "block", *left).agg(kids.alias("kids"))
        # a level that the group does not have leaves its only node as it is
        digest = F.when(F.col("levels") > done + k, _hash(_joined(F.col("kids")))).otherwise(F.get("kids", F.lit(0))["digest"])
        rows = rows.withColumn("digest", digest)
        held = ["digest", "kids"]
    return rows


def _roll_up(spark: SparkSession, nodes: DataFrame, group: str, payload: Sequence[str], label: str) -> tuple[list[DataFrame], DataFrame]:
    """The staged tiers over nodes (group, _pos, _size, digest, payload), and the root of each group."""
    nodes = nodes.withColumn("levels", _levels(F.col("_size")))
    most = nodes.agg(F.max("levels")).first()[0] or 0
    tiers = []
    for done in range(0, max(most, 1), DIGITS):
        tier = stage(spark, _tier(nodes, group, done, payload if not done else ()), f"{label}-tier")
        tiers.append(tier)
        nodes = tier.select(group, "levels", F.col("block").alias("_pos"), "digest")
    return tiers, nodes.select(group, "digest")


def _sides(kids: Column, at: Column) -> Column:
    """The siblings on both sides of the node in a place."""
    return F.struct(
        _joined(F.slice(kids, F.lit(1), at)).alias("left"),
        _joined(F.slice(kids, at + 2, F.lit(FAN))).alias("right"),
    )


def _come_down(tiers: list[DataFrame], above: DataFrame, group: str, payload: Sequence[str]) -> DataFrame:
    """The lowest nodes with ``proof``, the siblings of each level from the lowest to the root.

    ``above`` has one row for each group: the proof of its root, and columns that all nodes below get.
    """
    told = [c for c in above.columns if c not in (group, "proof")]
    sent = above.withColumn("block", F.lit(0).cast("long"))
    for number, tier in reversed(list(enumerate(tiers))):
        both = tier.select(group, "block", "levels", "kids").unionByName(sent, allowMissingColumns=True)
        met = both.groupBy(group, "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "kids", "proof", *told)])
        rows = met.withColumn("pos", F.col("block"))
        for k in reversed(range(DIGITS)):
            real = F.col("levels") > DIGITS * number + k
            extended = F.when(real, F.concat(F.array(_sides(F.col("kids"), F.col("at"))), F.col("proof"))).otherwise(F.col("proof"))
            rows = rows.select(group, "levels", "pos", "kids", "proof", *told, F.posexplode("kids").alias("at", "kid"))
            rows = rows.select(
                group, "levels", (F.col("pos") * FAN + F.col("at")).alias("pos"), extended.alias("proof"), *told,
                *([F.col("kid.kids").alias("kids")] if k else [F.col("kid.digest").alias("digest"), *[F.col(f"kid.{p}").alias(p) for p in payload if not number]]),
            )
        sent = rows.select(group, F.col("pos").alias("block"), "proof", *told)
    return rows.select(group, "pos", "digest", "proof", *told, *payload)


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves stand by doc_id in their source, those without one first, equal doc_ids by their leaf hash; sources stand by
    their bytes, no source first. A null field is ``-``. Repeated rows are leaves of their own. Rows whose doc_id has a crc32 that 5
    divides are shown with A-Z of the text in lower case: ``folded_root`` is what their siblings and the changed leaf
    give, and ``verified`` whether that is the root. A row without doc_id is shown as it is. Other columns are not
    looked at, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    fields = {name: F.col(name) for name in FIELDS}
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_OF == 0, F.lit(False))
    shown = fields | {"text": F.translate("text", UPPER, LOWER)}
    leaves = docs.select(
        "doc_id", "source", leaf_hash(list(fields.values())).alias("digest"), F.when(tampered, leaf_hash(list(shown.values()))).alias("shown")
    )
    leaves = keep_places(leaves, "merkle-leaves")
    ranked = number_in_order(leaves, ["source"], [F.col("doc_id").asc_nulls_first(), F.col("digest")], "merkle-order")
    tiers, subroots = _roll_up(spark, ranked, "source", ["doc_id", "shown"], "merkle-source")

    subroots = keep_places(subroots, "merkle-subroots")
    ordered = number_in_order(subroots, [], [F.col("source").asc_nulls_first()], "merkle-source-order").withColumn("dataset", F.lit(0))
    top_tiers, roots = _roll_up(spark, ordered, "dataset", ["source"], "merkle-root")
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    above = roots.select("dataset", F.col("digest").alias("root"), nothing.alias("proof"))
    sources = _come_down(top_tiers, above, "dataset", ["source"])
    rows = _come_down(tiers, sources.select("source", "proof", "root", F.col("digest").alias("subroot")), "source", ["doc_id", "shown"])

    folded = F.aggregate("proof", F.coalesce("shown", "digest"), lambda node, level: _hash(level["left"], node, level["right"]))
    siblings = F.transform("proof", lambda level: F.concat(level["left"], level["right"]))
    return rows.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root",
        F.sha2(F.array_join(siblings, "").cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
