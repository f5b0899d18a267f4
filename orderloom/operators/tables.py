"""Writing the tables: loads, range replacement, upserts and merges.

Monthly tables are partitioned by business month. A write makes new folders for the months that it changes, and the
catalogue then points the months to them (see ``tabled``): other months keep their files, and a write that fails changes
nothing. Where several tables change together, all of them are written before the first one switches. Rows
are counted by the writes themselves.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import tabled
from orderloom.functions.calendar import business_month, months_touched
from orderloom.operators import merges
from orderloom.schemas import conform, ensure_table, read_table, with_partition
from orderloom.session import stage, unsent


ROWS_A_TASK = 250_000  # parameter: rows of target and source that one task of an upsert joins
SMALL_SOURCE = 100_000  # parameter: sources of so many rows are left to Spark, which may broadcast them


def with_month(rows: DataFrame, ts_column: str, partition: str) -> DataFrame:
    return rows.withColumn(partition, business_month(F.col(ts_column)))


def replace_table(
    spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType, partition: str | None = None, order: Sequence[str] = (),
    cluster: int | None = None,
) -> int:
    """``rows`` take the place of all that the table held; returns their number. A partition column must be among them.

    With ``order`` the files hold ranges of it, ``cluster`` of them where that is given. Such rows are sampled before they are
    written, so they are best staged.
    """
    ensure_table(spark, path, schema, partition)
    written = tabled.write(spark, rows.select(*with_partition(schema, partition).names), path, partition, order, cluster)
    emptied = dict.fromkeys(tabled.parts(spark, path)) if partition else {}
    tabled.switch(spark, path, partition, emptied | tabled.places(written, partition))
    return written.rows


def load(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    disposition: str = "WRITE_APPEND",
    ignore_if_empty: bool = True,
    partition: str | None = None,
    ts_column: str | None = None,
    derived: dict[str, Column] | None = None,
) -> bool:
    """Append to a table, replace it, or fill it only while it is empty. Empty input changes nothing.

    Returns whether anything was written. The rows are computed once, and counted as they are written. They are dealt out by month as
    they come, and take the table's columns after that. ``derived`` has columns that follow from others of their row and are added then, so
    that these are not shuffled either.
    """
    if disposition not in ("WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY"):
        raise ValueError(f"unknown disposition {disposition!r}")
    keep: tuple[str, ...] = ()
    if partition and ts_column:
        placed = F.col(ts_column) if ts_column in rows.columns else F.lit(None)
        rows = rows.withColumn(partition, business_month(placed.cast(schema[ts_column].dataType)))
        keep = () if partition in schema.names else (partition,)

    def finish(dealt: DataFrame) -> DataFrame:
        return conform(dealt.withColumns(derived or {}), schema, keep)

    ensure_table(spark, path, schema, partition)
    if disposition == "WRITE_EMPTY" and not read_table(spark, path, schema, partition).isEmpty():
        raise ValueError(f"the table at {path} already has rows")
    if disposition == "WRITE_TRUNCATE":
        written = tabled.write(spark, rows, path, partition, finish=finish)
        loaded = written.rows
        if loaded:
            emptied = dict.fromkeys(tabled.parts(spark, path)) if partition else {}
            tabled.switch(spark, path, partition, emptied | tabled.places(written, partition))
    else:
        loaded = tabled.append(spark, rows, path, partition, finish)
    if not loaded and not ignore_if_empty:
        raise ValueError("no rows to load")
    return loaded > 0


def _month(partition: str, parts: Sequence[str]):
    """Rows of some partitions, by their folder names."""
    known = F.col(partition).isin([part for part in parts if part != tabled.NO_VALUE])
    return known | F.col(partition).isNull() if tabled.NO_VALUE in parts else known


def _range_content(
    spark: SparkSession, path: str, schema: T.StructType, incoming: DataFrame, ts_column: str, start_iso: str, end_iso: str,
    partition: str, keys: Sequence[str],
) -> tuple[dict[str, str | None], tabled.Written]:
    """The new folders of the months that a range replacement changes, and the incoming rows as they were written.

    The incoming rows are written first, and the folder tells their months. Months that the range does not cover in full are
    then merged with the rows that stay, from that folder.
    """
    full, partial = ([str(month) for month in months] for months in months_touched(start_iso, end_iso))
    fresh = tabled.write(spark, with_month(conform(incoming, schema), ts_column, partition), path, partition)
    changes: dict[str, str | None] = dict.fromkeys([*full, *partial]) | tabled.places(fresh, partition)
    merged = [part for part in {*partial, *fresh.parts} if part not in full]
    held = [part for part in merged if part in tabled.parts(spark, path)]
    if held:
        table = read_table(spark, path, schema, partition)
        landed = spark.read.schema(table.schema).option("basePath", fresh.folder).parquet(fresh.folder)
        kept = merges.delete_between(table.where(_month(partition, held)), ts_column, start_iso, end_iso)
        outside = merges.delete_between(landed, ts_column, start_iso, end_iso).select(*keys).distinct()
        kept = kept.join(outside, list(keys), "left_anti").select(*table.columns)
        content = kept.unionByName(landed.where(_month(partition, held)))
        changes |= dict.fromkeys(held) | tabled.places(tabled.write(spark, content, path, partition), partition)
    return changes, fresh


def _month_counts(spark: SparkSession, written: tabled.Written, schema: T.StructType, partition: str) -> dict[str, int]:
    """The written rows of each month, told by the ends of the files."""
    rows = spark.read.schema(with_partition(schema, partition)).option("basePath", written.folder).parquet(written.folder)
    return {str(row[partition]): row["n"] for row in rows.groupBy(partition).agg(F.count(F.lit(1)).alias("n")).collect()}  # one per month


def replace_ranges(
    spark: SparkSession,
    replacements: dict[str, tuple[T.StructType, DataFrame]],
    ts_column: str,
    start_iso: str,
    end_iso: str,
    partition: str = "order_month",
    keys: Sequence[str] = ("order_number",),
    counts: dict[str, dict[str, int]] | None = None,
) -> list[str]:
    """Delete the rows of ``[start, end)`` from some tables, given by path, and add the incoming ones; returns the months that changed.

    A month that the range covers in full is replaced without being read; in a month it covers in part, the
    rows outside it are carried over. Incoming rows outside the range take the place of rows outside it that have their
    keys, so that a second run with the same rows changes nothing. All tables are written before the first one switches.
    ``counts`` gets the incoming rows of each month, by path.
    """
    changes = {}
    for path, (schema, incoming) in replacements.items():
        changes[path], fresh = _range_content(spark, path, schema, incoming, ts_column, start_iso, end_iso, partition, keys)
        if counts is not None:
            counts[path] = _month_counts(spark, fresh, schema, partition)
    for path, changed in changes.items():
        tabled.switch(spark, path, partition, changed)
    return sorted({part for changed in changes.values() for part in changed if part != tabled.NO_VALUE})


def replace_range(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    incoming: DataFrame,
    ts_column: str,
    start_iso: str,
    end_iso: str,
    partition: str = "order_month",
    keys: Sequence[str] = ("order_number",),
) -> list[str]:
    """``replace_ranges`` for one table."""
    return replace_ranges(spark, {path: (schema, incoming)}, ts_column, start_iso, end_iso, partition, keys)


def delete_range(
    spark: SparkSession, path: str, schema: T.StructType, ts_column: str, start_iso: str, end_iso: str,
    partition: str = "order_month", keys: Sequence[str] = ("order_number",),
) -> list[str]:
    """Delete the rows of ``[start, end)``."""
    nothing = spark.createDataFrame([], schema)
    return replace_range(spark, path, schema, nothing, ts_column, start_iso, end_iso, partition, keys)


def _spread(frames: Sequence[DataFrame], keys: Sequence[str], pieces: int) -> list[DataFrame]:
    """Frames that are about to meet by their keys; dealt over ``pieces`` partitions, which the joins then use, if there are any."""
    return [frame.repartition(pieces, *keys) if pieces else frame for frame in frames]


def _pieces(target: DataFrame, source: DataFrame) -> int:
    """Over how many partitions a large target and source are dealt, so that a task sorts ``ROWS_A_TASK`` rows or so however large they are;
    0 where the session's number is enough, or where the source is small and may be broadcast. The rows of a table and of staged rows are
    counted from their footers."""
    incoming = source.count()
    pieces = math.ceil((target.count() + incoming) / ROWS_A_TASK)
    enough = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces if incoming > SMALL_SOURCE and pieces > enough else 0


def _hit(target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str) -> list[str]:
    """The partitions of the target that hold a key of the source."""
    matched = target.select(partition, *keys).join(source.select(*keys), list(keys), "left_semi")
    months = [row[0] for row in matched.select(partition).distinct().collect()]  # one value per month
    return [tabled.NO_VALUE if month is None else str(month) for month in months]


def _settle(spark: SparkSession, content: DataFrame, path: str, schema: T.StructType, partition: str, hit: Sequence[str]):
    """Write the new content of the ``hit`` partitions and rows that go to others; returns the step that shows them."""
    written = tabled.write(spark, content, path, partition)
    held = tabled.parts(spark, path)
    changes = dict.fromkeys(hit) | tabled.places(written, partition, [p for p in written.parts if p in hit or p not in held])
    added = [part for part in written.parts if part in held and part not in hit]

    def show() -> None:
        if added:  # months that just get rows keep their files
            table = read_table(spark, path, schema, partition)
            fresh = spark.read.schema(table.schema).option("basePath", written.folder).parquet(written.folder)
            tabled.append(spark, fresh.where(_month(partition, added)), path, partition)
        tabled.switch(spark, path, partition, changes)

    return show


def upsert(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source: DataFrame,
    keys: Sequence[str],
    partition: str | None = None,
    ts_column: str | None = None,
) -> bool:
    """Update or insert ``source`` by its keys. Only months that hold a matching row are read and written anew; months
    that just get rows get more files. The source is staged, since the merge reads it more than once. Large tables are
    dealt over more partitions than the session has, by their rows."""
    source = stage(spark, source, "source")
    if source.isEmpty():
        return False
    target = read_table(spark, path, schema, partition)
    pieces = _pieces(target, source)
    if not partition:
        held, source = _spread((target, source), keys, pieces)
        replace_table(spark, conform(merges.upsert_by_keys(held, source, keys), schema), path, schema)
        return True
    hit = _hit(*_spread((target.select(partition, *keys), source.select(*keys)), keys, pieces), keys, partition)
    held, source = _spread((target.where(_month(partition, hit)).select(*schema.names), source), keys, pieces)
    content = conform(merges.upsert_by_keys(held, source, keys), schema)
    if ts_column:
        content = with_month(content, ts_column, partition)
    _settle(spark, content, path, schema, partition, hit)()
    return True


def replace_keys(
    spark: SparkSession, replacements: dict[str, tuple[T.StructType, DataFrame]], numbers: DataFrame, keys: Sequence[str],
    ts_column: str, partition: str = "order_month",
) -> None:
    """Delete the rows that have a key of ``numbers`` from some tables and add the incoming ones; all are written before one switches.

    Only months that hold such a row are read and written anew. A second run with the same rows changes nothing. The keys are staged, since
    each table meets them twice.
    """
    steps = []
    numbers = stage(spark, numbers.select(*keys).distinct(), "keys")
    numbers = unsent(numbers, numbers.count())
    for path, (schema, incoming) in replacements.items():
        target = read_table(spark, path, schema, partition)
        hit = _hit(target, numbers, keys, partition)
        kept = target.where(_month(partition, hit)).join(numbers, list(keys), "left_anti")
        fresh = with_month(conform(incoming, schema), ts_column, partition)
        steps.append(_settle(spark, kept.select(*fresh.columns).unionByName(fresh), path, schema, partition, hit))
    for show in steps:
        show()


def insert_unmatched(spark: SparkSession, path: str, schema: T.StructType, source: DataFrame, keys: Sequence[str]) -> int:
    """Add the source rows whose keys the table does not hold; returns how many."""
    fresh = conform(merges.unmatched(source, read_table(spark, path, schema), keys), schema)
    return tabled.append(spark, fresh, path, None)


def rewrite_partitions(
    spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType, partition: str, parts: Sequence[str], order: Sequence[str] = ()
) -> int:
    """``rows`` become the content of some partitions, and those of them without rows go; returns the number of rows."""
    written = tabled.write(spark, rows.select(*with_partition(schema, partition).names), path, partition, order)
    strays = set(written.parts) - set(parts)
    if strays:
        raise ValueError(f"rows of partitions that were not to change: {sorted(strays)}")
    tabled.switch(spark, path, partition, dict.fromkeys(parts) | tabled.places(written, partition))
    return written.rows


def rewrite_changed(
    spark: SparkSession, path: str, rows: DataFrame, schema: T.StructType, flag: str, partition: str, order: Sequence[str] = ()
) -> int:
    """Write back the partitions that hold a row marked in ``flag``; returns how many rows are marked."""
    seen = Observation()
    staged = stage(spark, rows.observe(seen, F.count_if(flag).alias("marked")), "rewrite")
    count = seen.get["marked"]
    if count:
        months = [row[0] for row in staged.where(flag).select(partition).distinct().collect()]  # one value per month
        parts = [tabled.NO_VALUE if month is None else str(month) for month in months]
        rewrite_partitions(spark, staged.where(_month(partition, parts)).drop(flag), path, schema, partition, parts, order)
    return count
