"""Exact deduplication by a tree merge of sorted digest runs; DataFrame functions only.

Every row gets a slim record: its digest, and a second hash and the length that verify it. What a task reads becomes
a run: one record per digest, with the identifier that stays and the number of copies. A digest that holds a third of all
rows is one record per run from there on. Runs are then exchanged once, by ranges of digests, and each task sorts
its piece of all runs by digest and run. In each binomial round the runs that differ in their last bit merge into one: the
bit goes, and as the rest is in order already, a round is a pass over neighbouring records, without a shuffle or a sort. After the last
round one run is left, spread over all tasks by digest.

The digest is never trusted alone: a record merges only with records whose second hash and length agree too, at
every level. Texts are not shuffled, only the records.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import without
from orderloom.session import stage

VERIFIED = ["digest", "check", "n_bytes"]


def digest_records(docs: DataFrame, id_column: str = "doc_id", text: Column | None = None) -> DataFrame:
    """(doc_id, digest, check, n_bytes) of every row; a null text counts as empty."""
    body = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        F.xxhash64(body).alias("check"),
        F.octet_length(body).cast("long").alias("n_bytes"),
    )


def merge_runs(records: DataFrame, runs: int, largest: bool = True) -> DataFrame:
    """One row per distinct text: its verified digest, the identifier that stays and the number of rows.

    Tasks share ``runs`` runs, rounded up to a power of two, so a task of the exchange gets at most that many records of a digest.
    """
    stays = F.max if largest else F.min
    rounds = max(1, math.ceil(math.log2(max(runs, 2))))
    bits = [f"bit{k}" for k in reversed(range(rounds))]
    task = F.spark_partition_id()
    of_run = [F.shiftright(task, k).bitwiseAND(1).alias(f"bit{k}") for k in reversed(range(rounds))]
    level = records.select("*", *of_run).groupBy(*VERIFIED, *bits).agg(stays("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # a struct is folded along the order of its keys, not in a hash table; no identifier, no struct
    stay = F.when(F.col("keep_id").isNotNull(), F.struct("keep_id")).alias("stays")
    level = level.select(*VERIFIED, *bits, stay, "group_size")
    level = level.repartitionByRange(runs, "digest").sortWithinPartitions(*VERIFIED, *bits)
    while bits:
        bits = bits[:-1]
        level = level.groupBy(*VERIFIED, *bits).agg(stays("stays").alias("stays"), F.sum("group_size").alias("group_size"))
    return level.select(*VERIFIED, "stays.keep_id", "group_size")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: Column | None = None, largest: bool = True) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (lowercase hex).

    Null texts count as empty and are equal to each other. ``doc_id`` is the identity: rows that repeat one
    with the same text are all kept or all dropped, and each counts in ``group_size``. A null doc_id is only
    kept where no other identifier has its text. Other columns of ``docs`` are not looked at, whatever their
    names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    records = stage(spark, digest_records(docs, id_column, text), "digest-records")
    groups = merge_runs(records, int(spark.conf.get("spark.sql.shuffle.partitions")), largest)
    return records.join(groups, VERIFIED).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows without an identifier stay."""
    return without(docs, exact_duplicates(docs).where(~F.col("kept")))
