"""Gapless numbers in a given order over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.session import stage


def numbered(rows: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``rows`` with ``position``, from 0 without gaps in the given order.

    Rows are cut into ranges of that order and counted as they lie; the rows of the ranges before are a running sum over one row
    for each range. Rows that the order does not tell apart may be spread over ranges by the number they get when they are staged.
    """
    spark = rows.sparkSession
    placed = stage(spark, rows.withColumn("_row", F.monotonically_increasing_id()), label)
    keys = [*order, F.col("_row")]
    laid = placed.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
    # the first 31 bits of such a number are the task's, the others count its rows
    laid = stage(spark, laid.drop("_row").withColumn("_line", F.monotonically_increasing_id()), label)
    return _gapless(laid, rows.columns)


def numbered_as_they_lie(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` with ``position``, from 0 without gaps in no order of meaning: nothing is sorted or shuffled."""
    laid = rows.withColumn("_line", F.monotonically_increasing_id())
    return _gapless(stage(rows.sparkSession, laid, label, codec="zstd"), rows.columns)


def _gapless(laid: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Positions from staged rows with their ``_line``: rows of the tasks before, and the row's number in its own."""
    part = F.shiftright("_line", 33)
    counts = {row["part"]: row["n"] for row in laid.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one per task
    before, starts = 0, []
    for task in range(max(counts, default=-1) + 1):
        starts.append(F.lit(before).cast("long"))
        before += counts.get(task, 0)
    # looked up in a list of one number per task: a join would shuffle the rows
    position = F.get(F.array(*starts).cast("array<long>"), part.cast("int")) + F.col("_line").bitwiseAND((1 << 33) - 1)
    return laid.select(*columns, position.alias("position"))
