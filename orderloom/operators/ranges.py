"""Month ranges, weekly chunks and backfill plans as tables, and order counts over them.

All times here are business wall-clock times (TIMESTAMP_NTZ); ends are open.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.calendar import CHUNK_DAYS, DETAIL_BATCH, SEARCH_CAP, business_date, local_time, month_of


def span_table(spark: SparkSession, span: tuple[datetime, datetime]) -> DataFrame:
    """One row ``start``, ``end`` from job parameters."""
    start, end = (F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz") for moment in span)
    return spark.range(1).select(start.alias("start"), end.alias("end"))


def order_span(orders: DataFrame) -> DataFrame:
    """One row from the day of the first order to the end of the day of the last one."""
    day = business_date(F.col("order_datetime"))
    span = orders.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return span.select(
        F.col("first").cast("timestamp_ntz").alias("start"),
        F.date_add("last", 1).cast("timestamp_ntz").alias("end"),
    )


def monthly_ranges(spans: DataFrame) -> DataFrame:
    """Each span cut at month borders, other columns kept.

    The first range starts at the first of its month even where the span starts later; the last one
    ends where the span ends.
    """
    others = [c for c in spans.columns if c not in ("start", "end")]
    first = month_of(F.to_date("start"))
    last = month_of(F.to_date(F.col("end") - F.expr("interval 1 microsecond")))
    months = F.when(last >= first, F.sequence(first, last, F.expr("interval 1 month")))
    listed = spans.select(*others, "end", F.explode(months).alias("month"))
    return listed.select(
        *others,
        "month",
        F.col("month").cast("timestamp_ntz").alias("range_start"),
        F.least(F.add_months("month", 1).cast("timestamp_ntz"), F.col("end")).alias("range_end"),
    )


def weekly_chunks(ranges: DataFrame) -> DataFrame:
    """Each range cut into chunks of seven days, the last one shorter."""
    step = F.expr(f"interval {CHUNK_DAYS} days")
    starts = F.sequence("range_start", F.col("range_end") - F.expr("interval 1 microsecond"), step)
    return ranges.withColumn("chunk_start", F.explode(starts)).withColumn(
        "chunk_end", F.least(F.col("chunk_start") + step, F.col("range_end"))
    )


def _placed_by_month(orders: DataFrame) -> DataFrame:
    at = F.col("order_datetime")
    return orders.select("order_number", local_time(at).alias("placed"), month_of(business_date(at)).alias("month"))


def order_counts(orders: DataFrame, ranges: DataFrame) -> DataFrame:
    """Distinct order numbers placed in each range, zero included.

    Orders meet their range by equality on the month. The ranges are one row per month, which Spark
    broadcasts after it has checked their size.
    """
    inside = _placed_by_month(orders).join(ranges, "month").where("placed >= range_start and placed < range_end")
    counts = inside.groupBy("range_start").agg(F.countDistinct("order_number").alias("found"))
    return ranges.join(counts, "range_start", "left").select(
        "month", "range_start", "range_end", F.coalesce("found", F.lit(0)).cast("bigint").alias("order_numbers")
    )


def chunk_counts(orders: DataFrame, ranges: DataFrame) -> DataFrame:
    """Distinct order numbers per weekly chunk, and whether one search call could return them all."""
    inside = _placed_by_month(orders).join(ranges, "month").where("placed >= range_start and placed < range_end")
    day = F.datediff(F.to_date("placed"), F.col("month"))
    chunk = inside.withColumn("chunk", F.floor(day / CHUNK_DAYS).cast("int"))
    counts = chunk.groupBy("month", "chunk").agg(F.countDistinct("order_number").alias("found"))
    chunks = weekly_chunks(ranges).withColumn(
        "chunk", F.floor(F.datediff(F.to_date("chunk_start"), F.col("month")) / CHUNK_DAYS).cast("int")
    )
    total = F.coalesce("found", F.lit(0)).cast("bigint")
    return chunks.join(counts, ["month", "chunk"], "left").select(
        "month",
        "chunk_start",
        "chunk_end",
        total.alias("order_numbers"),
        (total > SEARCH_CAP).alias("over_cap"),
    )


def backfill_plan(ranges: DataFrame) -> DataFrame:
    """One task per month: its name, first day and last day included."""
    return ranges.select(
        F.date_format("month", "yyyy-MM").alias("month"),
        F.to_date("range_start").alias("start_day"),
        F.date_sub(F.to_date("range_end"), 1).alias("end_day"),
    )


def backfill_load(orders: DataFrame, ranges: DataFrame) -> DataFrame:
    """The plan with the orders each task has to fetch and the detail calls they take."""
    counts = order_counts(orders, ranges)
    calls = F.ceil(F.col("order_numbers") / DETAIL_BATCH).cast("bigint")
    numbers = counts.select(F.date_format("month", "yyyy-MM").alias("month"), "order_numbers", calls.alias("detail_calls"))
    return backfill_plan(ranges).join(numbers, "month")


def run_totals(counts: DataFrame) -> DataFrame:
    """Ranges and order numbers of a whole run."""
    return counts.agg(
        F.count(F.lit(1)).alias("ranges_count"), F.sum("order_numbers").cast("bigint").alias("order_numbers")
    )
