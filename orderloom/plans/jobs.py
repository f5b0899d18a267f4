"""The jobs a user calls: a month's load, a whole span, the first full load, the master sync."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas, tabled
from orderloom.functions.calendar import (
    BUSINESS_TZ, iso_instant, iso_local, month_start, months_touched, resolve_span, shift_month,
)
from orderloom.operators import cohort_ltv, first_purchase, flatten, product_master, quality, ranges, tables
from orderloom.session import cleared, pin_utc, stage
from orderloom.sources.documents import staged_once

log = logging.getLogger(__name__)

LTV_ORDER = ["entry_manage_number", "month_offset"]


@dataclass(frozen=True)
class Warehouse:
    """The five tables below one folder."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    SCHEMAS = {
        "orders": schemas.ORDERS,
        "order_items": schemas.ORDER_ITEMS,
        "product_master_raw": schemas.PRODUCT_MASTER,
        "user_first_purchase_info": schemas.FIRST_PURCHASE,
        "entry_product_ltv_by_month_offset": schemas.COHORT_LTV,
    }
    PARTITIONS = {
        "orders": "order_month",
        "order_items": "order_month",
        "entry_product_ltv_by_month_offset": "first_order_month",
    }

    def create(self, spark: SparkSession) -> list[str]:
        """Create the tables that are not there yet; returns their names."""
        return [
            name
            for name, schema in self.SCHEMAS.items()
            if schemas.ensure_table(spark, self.path(name), schema, self.PARTITIONS.get(name))
        ]

    def name(self, table: str) -> str:
        """The table's name in SQL."""
        return tabled.identifier(self.path(table))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return schemas.read_table(spark, self.path(table), self.SCHEMAS[table], self.PARTITIONS.get(table))


def _now(run_at: datetime | None) -> datetime:
    """The stamp of a run as UTC wall-clock time."""
    return (run_at or datetime.now(timezone.utc)).replace(tzinfo=None)


def _stamped(rows: DataFrame, run_at: datetime) -> DataFrame:
    return rows.withColumn("updated_at", F.lit(str(run_at)).cast("timestamp"))


def _names(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return product_master.best_names(warehouse.read(spark, "product_master_raw"))


# --- orders and items ----------------------------------------------------------------------------
@cleared
def load_span(
    spark: SparkSession,
    warehouse: Warehouse,
    documents: DataFrame,
    start: datetime,
    end: datetime,
    run_at: datetime | None = None,
    searched: DataFrame | None = None,
    quarantine: str | None = None,
) -> dict:
    """Replace the orders and items placed in ``[start, end)`` (business time) by those of ``documents``.

    The documents are read and parsed once, and both tables are written before one of them switches to the new rows. Nothing changes when the documents
    are empty, when one of them fails the checks, or when an order number of ``searched`` was not fetched. With
    ``quarantine``, documents that fail the checks are appended to that folder as JSON and the others are loaded.
    ``months`` has one row per business month, and ``changed_months`` names those whose rows were replaced.
    """
    pin_utc(spark)
    run_at = _now(run_at)
    start_iso, end_iso = iso_instant(start), iso_instant(end)
    summary: dict = {"range": [start_iso, end_iso], "orders_rows": 0, "order_items_rows": 0}

    staged = staged_once(documents, "documents")
    if searched is not None:
        fetched = staged.select(F.col("orderNumber").alias("order_number"))
        lost = quality.missing_orders(searched, fetched).count()
        if lost:
            raise ValueError(f"{lost} order numbers were found but not fetched")
    report = {row["rule"]: row for row in quality.reject_report(staged).collect()}  # one row per rule
    broken = {rule: row["rejected"] for rule, row in report.items() if row["rejected"]}
    if broken and quarantine is None:
        raise ValueError(f"documents rejected: {broken}")
    if broken:
        staged, bad = quality.split_documents(staged)
        bad.write.mode("append").json(quarantine)
        report = {row["rule"]: row for row in quality.reject_report(staged).collect()}
        summary["rejected"] = broken
    summary["orders_rows"] = report["order_number_missing"]["checked"]
    summary["order_items_rows"] = report["item_id_missing"]["checked"]
    if summary["orders_rows"] == 0:
        return {**summary, "note": "no_orders_skip"}

    orders, items = flatten.normalize_all(staged, run_at, with_order_datetime=True)
    counts: dict[str, dict[str, int]] = {}
    summary["changed_months"] = tables.replace_ranges(
        spark,
        {
            warehouse.path("orders"): (schemas.ORDERS, orders),
            warehouse.path("order_items"): (schemas.ORDER_ITEMS, items),
        },
        "order_datetime", start_iso, end_iso, counts=counts,
    )
    summary["months"] = _month_rows(counts[warehouse.path("orders")], counts[warehouse.path("order_items")])
    return summary


def _month_rows(orders: dict[str, int], items: dict[str, int]) -> list[dict]:
    """Order and item rows of each business month."""
    return [{"month": month, "orders_rows": rows, "order_items_rows": items.get(month, 0)} for month, rows in sorted(orders.items())]


# --- derived tables ------------------------------------------------------------------------------
@cleared
def merge_first_purchases(
    spark: SparkSession,
    warehouse: Warehouse,
    month: datetime,
    until: datetime | None = None,
    run_at: datetime | None = None,
    cancelled: Sequence[str] = first_purchase.CANCELLED,
) -> dict:
    """Add the users who are new in ``[month, until)``, one month unless ``until`` is given. Users already
    known are never changed.

    Orders after those months cannot move a first order into them, so their partitions are not read, and
    an item lies in the same month as its order, so the items of those months are enough. Merging several
    months at once adds the same users as merging them one after the other.
    """
    pin_utc(spark)
    until = month_start(until) if until else shift_month(month, 1)
    start_day, end_day = f"{month:%Y-%m-01}", f"{until:%Y-%m-01}"
    start, end = F.lit(start_day).cast("date"), F.lit(end_day).cast("date")
    placed = F.col("order_month")
    orders = warehouse.read(spark, "orders").where(placed < end)
    items = warehouse.read(spark, "order_items").where((placed >= start) & (placed < end))
    known = warehouse.read(spark, "user_first_purchase_info")
    found = first_purchase.new_first_purchases(orders, items, _names(spark, warehouse), known, start_day, end_day, cancelled)
    inserted = tables.insert_unmatched(
        spark,
        warehouse.path("user_first_purchase_info"),
        schemas.FIRST_PURCHASE,
        _stamped(found, _now(run_at)),
        ["user_email"],
    )
    return {"inserted_users": inserted, "month": start_day}


@cleared
def rebuild_first_purchases(
    spark: SparkSession, warehouse: Warehouse, run_at: datetime | None = None, cancelled: Sequence[str] = first_purchase.CANCELLED
) -> int:
    """All users from the full history, in place of what the table held; returns their number."""
    pin_utc(spark)
    rows = first_purchase.first_purchases(
        warehouse.read(spark, "orders"), warehouse.read(spark, "order_items"), _names(spark, warehouse), cancelled
    )
    content = schemas.conform(_stamped(rows, _now(run_at)), schemas.FIRST_PURCHASE)
    return tables.replace_table(spark, content, warehouse.path("user_first_purchase_info"), schemas.FIRST_PURCHASE)


@cleared
def rebuild_ltv(
    spark: SparkSession, warehouse: Warehouse, run_at: datetime | None = None, cancelled: Sequence[str] = first_purchase.CANCELLED
) -> None:
    """The cohort table over all history, one folder per first month, its files in ranges of product and offset."""
    pin_utc(spark)
    rows = cohort_ltv.ltv_by_month_offset(
        warehouse.read(spark, "user_first_purchase_info"), warehouse.read(spark, "orders"), _names(spark, warehouse), cancelled
    )
    content = stage(spark, schemas.conform(_stamped(rows, _now(run_at)), schemas.COHORT_LTV), "cohorts")
    path = warehouse.path("entry_product_ltv_by_month_offset")
    tables.replace_table(spark, content, path, schemas.COHORT_LTV, "first_order_month", LTV_ORDER)


@cleared
def refresh_ltv(
    spark: SparkSession, warehouse: Warehouse, months: Sequence[date], run_at: datetime | None = None,
    cancelled: Sequence[str] = first_purchase.CANCELLED,
) -> dict:
    """Bring the cohort table up to date after the orders of some months were loaded and their new users merged.

    Reads the orders of those months, and of later ones for users who are new in them. Only first months with a buyer in the
    months are written, which ``first_months`` names. The result is that of ``rebuild_ltv``, as long as first purchases were only
    merged and the master is the same.
    """
    pin_utc(spark)
    if not months:
        return {"first_months": []}
    table = "entry_product_ltv_by_month_offset"
    rows, touched = cohort_ltv.changed_cohorts(
        warehouse.read(spark, table), warehouse.read(spark, "user_first_purchase_info"), warehouse.read(spark, "orders"),
        _names(spark, warehouse), months, cancelled,
    )
    content = stage(spark, schemas.conform(_stamped(rows, _now(run_at)), schemas.COHORT_LTV), "cohorts")
    parts = [str(month) for month in touched]
    tables.rewrite_partitions(spark, content, warehouse.path(table), schemas.COHORT_LTV, "first_order_month", parts, LTV_ORDER)
    return {"first_months": parts}


@cleared
def refresh_ltv_names(spark: SparkSession, warehouse: Warehouse, run_at: datetime | None = None) -> dict:
    """Bring the cohort table's names up to the master's; returns the number of rows changed."""
    pin_utc(spark)
    table = "entry_product_ltv_by_month_offset"
    rows = cohort_ltv.refreshed_names(
        warehouse.read(spark, table), warehouse.read(spark, "order_items"), _names(spark, warehouse)
    )
    stamp = F.when(F.col("name_changed"), F.lit(str(_now(run_at))).cast("timestamp")).otherwise(F.col("updated_at"))
    updated = tables.rewrite_changed(
        spark, warehouse.path(table), rows.withColumn("updated_at", stamp), schemas.COHORT_LTV, "name_changed", "first_order_month", LTV_ORDER
    )
    return {"updated_rows": updated}


# --- product master ------------------------------------------------------------------------------
# The status words of a master sync
SKIPPED, TRIED, DONE, FAILED = "skipped", "dry_run", "success", "error"


class NothingToSync(ValueError):
    """There is no master to load; ``str`` of it is the reason."""


@cleared
def replace_master(spark: SparkSession, warehouse: Warehouse, raw: DataFrame | None, write: bool = True) -> int:
    """Replace the product master by ``raw`` after cleaning; returns its number of rows. An empty master, or none,
    raises and never touches the table."""
    pin_utc(spark)
    if raw is None:
        raise NothingToSync("no_source")
    rows = stage(spark, product_master.clean_master(raw), "master")
    count = rows.count()
    if not count:
        raise NothingToSync("empty_master")
    if write:
        tables.replace_table(spark, schemas.conform(rows, schemas.PRODUCT_MASTER), warehouse.path("product_master_raw"), schemas.PRODUCT_MASTER)
    return count


def sync_master(
    spark: SparkSession,
    warehouse: Warehouse,
    raw: DataFrame | None,
    source: str = "",
    required: bool = False,
    dry_run: bool = False,
) -> dict:
    """``replace_master`` for a run that goes on without it: what went wrong is told as a status, unless ``required``."""
    told = {"source": source} if raw is not None else {}
    try:
        count = replace_master(spark, warehouse, raw, not dry_run)
    except NothingToSync as reason:
        if required:
            raise
        return {"status": SKIPPED, "reason": str(reason), **told}
    except Exception as problem:
        if required:
            raise
        return _failure("product master sync", problem)
    return {"status": TRIED if dry_run else DONE, "rows": count, "table": warehouse.path("product_master_raw"), **told}


def sync_master_and_names(spark: SparkSession, warehouse: Warehouse, raw: DataFrame | None, source: str = "") -> dict:
    """Master sync, then the cohort table's names."""
    return {
        "master_sync": sync_master(spark, warehouse, raw, source),
        "ltv_names_updated": refresh_ltv_names(spark, warehouse),
    }


# --- whole runs ----------------------------------------------------------------------------------
def _apart(result: dict, key: str, job) -> None:
    """Run a derived job; its failure is noted and does not undo the load."""
    try:
        result[key] = job()
    except Exception as problem:
        result[key] = _failure(key, problem)


def _failure(what: str, problem: Exception) -> dict:
    log.exception("%s failed, the rest of the run goes on", what)
    return {"status": FAILED, "error": str(problem)}


def process_span(
    spark: SparkSession,
    warehouse: Warehouse,
    documents: DataFrame,
    start: datetime,
    end: datetime,
    run_at: datetime | None = None,
    skip_ltv: bool = False,
    searched: DataFrame | None = None,
    quarantine: str | None = None,
    incremental: bool = False,
    cancelled: Sequence[str] = first_purchase.CANCELLED,
) -> dict:
    """One month or several: orders and items, then first purchases, then the cohort table.

    ``incremental`` changes only the cohorts with buyers in the months that were loaded.
    """
    result = load_span(spark, warehouse, documents, start, end, run_at, searched, quarantine)
    if "note" in result:
        return result
    until = month_start(end) if end == month_start(end) else shift_month(end, 1)
    _apart(result, "first_purchase_update", lambda: merge_first_purchases(spark, warehouse, start, until, run_at, cancelled))
    months = [date.fromisoformat(month) for month in result["changed_months"]]
    if not skip_ltv and incremental:
        _apart(result, "ltv_update", lambda: refresh_ltv(spark, warehouse, months, run_at, cancelled))
    elif not skip_ltv:
        _apart(result, "ltv_update", lambda: rebuild_ltv(spark, warehouse, run_at, cancelled))
    return result


def run(
    spark: SparkSession,
    warehouse: Warehouse,
    documents: DataFrame,
    mode: str = "MONTHLY",
    start: str | None = None,
    end: str | None = None,
    now: datetime | None = None,
    master: DataFrame | None = None,
    run_at: datetime | None = None,
    skip_ltv: bool = False,
    incremental: bool = False,
    cancelled: Sequence[str] = first_purchase.CANCELLED,
) -> dict:
    """A whole run: master sync, then every month of the mode's span in one load."""
    first, last = resolve_span(mode, start, end, now)
    first = month_start(first)
    iso = iso_instant(first), iso_instant(last)
    summary = {"mode": mode.upper(), "ranges_count": sum(len(months) for months in months_touched(*iso))}
    summary["master_sync"] = sync_master(spark, warehouse, master)
    summary.update(process_span(spark, warehouse, documents, first, last, run_at, skip_ltv, incremental=incremental, cancelled=cancelled))
    return summary


def backfill(
    spark: SparkSession,
    warehouse: Warehouse,
    documents: DataFrame,
    span: tuple[datetime, datetime],
    run_at: datetime | None = None,
    cancelled: Sequence[str] = first_purchase.CANCELLED,
) -> dict:
    """Every month of a span in one load, then first purchases and cohorts over the full history. ``months`` has a row for
    each month that got orders, and ``ranges_count`` is the number of months in the span."""
    result = load_span(spark, warehouse, documents, month_start(span[0]), span[1], run_at)
    result["ranges_count"] = sum(len(part) for part in months_touched(*result["range"]))
    result.update(initial_load(spark, warehouse, run_at, cancelled))
    return result


def initial_load(
    spark: SparkSession, warehouse: Warehouse, run_at: datetime | None = None, cancelled: Sequence[str] = first_purchase.CANCELLED
) -> dict:
    """First purchases over all history, then the cohort table. Running it again changes nothing."""
    users = rebuild_first_purchases(spark, warehouse, run_at, cancelled)
    rebuild_ltv(spark, warehouse, run_at, cancelled)
    return {"users": users}


def dry_run(
    spark: SparkSession,
    found: DataFrame,
    mode: str = "MONTHLY",
    start: str | None = None,
    end: str | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Order numbers per range of a run, without writing. ``found`` has order_number and order_datetime."""
    pin_utc(spark)
    spans = ranges.span_table(spark, resolve_span(mode, start, end, now))
    counts = ranges.order_counts(found, ranges.monthly_ranges(spans))
    return counts.select(
        iso_local(_as_instant(F.col("range_start"))).alias("range_start"),
        iso_local(_as_instant(F.col("range_end"))).alias("range_end"),
        "order_numbers",
    )


def _as_instant(local):
    """Business wall-clock time back to an instant (the session runs in UTC)."""
    return F.convert_timezone(F.lit(BUSINESS_TZ), F.lit("UTC"), local).cast("timestamp")
