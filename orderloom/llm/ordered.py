"""Gapless numbers in a given order, dealt out so that no group has to fit into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.session import stage


def keep_places(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written down with a number of their own, ``_row``, which tells equal rows apart."""
    return stage(rows.sparkSession, rows.withColumn("_row", F.monotonically_increasing_id()), label)


def number_in_order(placed: DataFrame, groups: Sequence[str], order: Sequence[Column], label: str) -> DataFrame:
    """The rows of ``keep_places`` with ``_pos``, from 0 in each group by ``order``, and ``_size``, the rows of the group.

    Rows are cut into ranges by group and order, with ``_row`` as the last word, so that a group with a third of all
    rows, or of rows that are all alike, spreads over many tasks. Within a range rows are counted as they lie. What
    came before a range in its group is a sum over one row for each range that the group touches.
    """
    spark = placed.sparkSession
    keys = [*[F.col(g).asc_nulls_first() for g in groups], *order, F.col("_row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    laid = laid.withColumn("_part", F.spark_partition_id()).withColumn("_line", F.monotonically_increasing_id())
    laid = stage(spark, laid, label)
    group = Window.partitionBy(*groups)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        laid.groupBy(*groups, "_part")
        .agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_size", F.sum("_n").over(group))
    )
    same = F.col("l._part") == F.col("f._part")
    for name in groups:
        same &= F.col(f"l.{name}").eqNullSafe(F.col(f"f.{name}"))
    return laid.alias("l").join(firsts.alias("f"), same).select(
        *[F.col(f"l.{c}") for c in placed.columns if c != "_row"],
        (F.col("l._line") - F.col("f._first") + F.col("f._before")).alias("_pos"),
        F.col("f._size"),
    )
