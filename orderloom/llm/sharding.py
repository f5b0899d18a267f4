"""Shards by jump consistent hashing; DataFrame functions only.

A key walks through the shard counts at which it would change its shard: from shard b the next change is at
floor((b + 1) / u) for the key's next draw u in (0, 1]. The last shard below the number of shards is the key's. No ring
is stored, and one more shard takes rows only into itself: each key moves there with probability 1 / (n + 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.session import stage

# A key takes about ln(n) jumps. Those that need more than this walk on in a second expression, to the end.
USUAL_JUMPS = 24
ROWS_PER_BLOCK = 2000


def _walk(key: Column, shards: int, state: Column, first: int, last: int) -> Column:
    def jump(at: Column, step: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, step), 33) + 1) / F.lit(float(1 << 31))
        further = F.struct(at["next"].alias("shard"), F.floor((at["next"] + 1) / u).cast("long").alias("next"))
        return F.when(at["next"] < shards, further).otherwise(at)

    return F.aggregate(F.sequence(F.lit(first), F.lit(last)), state, jump)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard in [0, shards) of a key; it depends on the key and the number of shards alone. Null keys share one."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    start = F.struct(F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"))
    # every jump leads at least one shard further, so that ``shards`` steps always suffice
    walked = _walk(key, shards, start, 1, min(shards, USUAL_JUMPS))
    if shards > USUAL_JUMPS:
        walked = F.when(walked["next"] < shards, _walk(key, shards, walked, USUAL_JUMPS + 1, shards)).otherwise(walked)
    return walked["shard"].cast("int")


def shard_documents(docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ('key'), shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1, and a null text has none; its crc32 is that of no bytes. Slots
    count 0, 1, 2, ... in every shard. Repeated rows get a slot each. Rows without an identifier
    share a shard. An empty table gives an empty result. Other columns are not looked at.

    Slots are numbered block by block: rows fall into blocks by a hash of the whole record, counts of blocks give
    each one its first slot, and a window numbers the rows of one block. No task sees a whole shard.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    slim = stage(
        spark,
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            jump_shard(F.col(id_column), shards).alias("shard"),
            jump_shard(F.col(id_column), shards + 1).alias("grown_shard"),
        ),
        "shards",
    )
    return number_rows(slim, ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def number_rows(staged: DataFrame, groups: list[str], name: str) -> DataFrame:
    """``staged`` with a gapless number from 0 in each group, by hashed blocks of about ROWS_PER_BLOCK rows."""
    columns = staged.columns
    n_blocks = max(1, -(-staged.count() // ROWS_PER_BLOCK))
    blocked = staged.withColumn("_block", F.pmod(F.xxhash64(*columns), F.lit(n_blocks)))
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        blocked.groupBy(*groups, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*groups, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    within = Window.partitionBy(*groups, "_block").orderBy(*columns)
    return (
        blocked.withColumn("_place", F.row_number().over(within) - 1)
        .join(firsts, [*groups, "_block"])
        .select(*columns, (F.col("_first") + F.col("_place")).cast("long").alias(name))
    )
