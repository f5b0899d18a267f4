"""The registered queries: every operator over the whole given tables.

Days and times are shown as text, so that a result reads the same in any client.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import schemas
from orderloom.functions.calendar import DETAIL_BATCH, business_date, iso_instant, iso_local, month_of, shift_month
from orderloom.operators import (
    cohort_ltv, first_purchase, flatten, merges, product_master, quality, ranges, reports, tables,
)
from orderloom.plans import given_tables as given
from orderloom.plans import jobs
from orderloom.session import pin_utc, scratch_path, stage
from orderloom.sources import documents, files, master_files
from orderloom.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Job parameters of the registered upkeep queries
MERGE_MONTH = "1995-06-01"
KNOWN_UNTIL = "1995-07-01T00:00:00+09:00"
REPLACED = ("1997-03-01T00:00:00+09:00", "1997-04-11T00:00:00+09:00")
STRAYS = ("1997-05-01T00:00:00+09:00", "1997-05-03T00:00:00+09:00")
ALL_TIME = (datetime(1992, 1, 1), datetime(2003, 1, 1))
DELETED = ("2024-01-08T00:00:00+09:00", "2024-01-15T12:00:00+09:00")
INGESTED_AT = datetime(2024, 2, 1)


def _as_text(rows: DataFrame) -> DataFrame:
    def shown(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return value.cast("string").alias(field.name)
        return value

    return rows.select(*[shown(f) for f in rows.schema.fields])


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _as_text(build(pin_utc(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def _names(spark, sf):
    return product_master.best_names(given.shop_master(spark, sf))


def _first(spark, sf):
    return first_purchase.first_purchases(given.shop_orders(spark, sf), given.shop_items(spark, sf), _names(spark, sf))


def _first_table(spark, sf):
    """First purchases as a written table, the way the cohort job finds them; read twice, made once."""
    return stage(spark, _first(spark, sf), "first-purchase")


# --- cohorts -------------------------------------------------------------------------------------
@query
def base_orders(spark, sf):
    return first_purchase.base_orders(given.shop_orders(spark, sf))


@query
def product_master_best(spark, sf):
    return _names(spark, sf)


@query
def user_monthly_sales(spark, sf):
    return cohort_ltv.user_monthly_sales(given.shop_orders(spark, sf))


@query
def user_first_order(spark, sf):
    return first_purchase.first_orders(given.shop_orders(spark, sf))


@query
def entry_products(spark, sf):
    first = first_purchase.first_orders(given.shop_orders(spark, sf))
    return first_purchase.entry_products(first, given.shop_items(spark, sf), _names(spark, sf))


@query
def first_purchase_full(spark, sf):
    return _first(spark, sf)


@query
def first_purchase_merge(spark, sf):
    orders, items, names = given.shop_orders(spark, sf), given.shop_items(spark, sf), _names(spark, sf)
    # what the table holds: delivered orders only, as they stood before the month was merged
    early = orders.where("order_status = '700'").where(
        F.col("order_datetime") < F.lit(KNOWN_UNTIL).cast("timestamp")
    )
    known = first_purchase.first_purchases(early, items, names)
    added = first_purchase.new_first_purchases(orders, items, names, known, MERGE_MONTH)
    return known.withColumn("inserted", F.lit(False)).unionByName(added.withColumn("inserted", F.lit(True)))


@query
def user_cohort_sales(spark, sf):
    return cohort_ltv.user_cohort_sales(_first(spark, sf), given.shop_orders(spark, sf), _names(spark, sf))


@query
def cohort_counts(spark, sf):
    return cohort_ltv.cohort_counts(_first(spark, sf), _names(spark, sf))


@query
def ltv_monthly_aggregated(spark, sf):
    return cohort_ltv.ltv_monthly_aggregated(_first_table(spark, sf), given.shop_orders(spark, sf), _names(spark, sf))


@query
def ltv_by_month_offset(spark, sf):
    return cohort_ltv.ltv_by_month_offset(_first_table(spark, sf), given.shop_orders(spark, sf), _names(spark, sf))


@query
def ltv_canonical(spark, sf):
    return cohort_ltv.ltv_canonical(_first_table(spark, sf), given.shop_orders(spark, sf), _names(spark, sf))


@query
def ltv_name_refresh(spark, sf):
    # the cohort table as named by an older master, which knew the smaller sizes only
    older = product_master.best_names(given.shop_master(spark, sf).where("cast(brand_name as int) <= 25"))
    ltv = cohort_ltv.ltv_by_month_offset(_first_table(spark, sf), given.shop_orders(spark, sf), older)
    return cohort_ltv.refreshed_names(ltv, given.shop_items(spark, sf), _names(spark, sf))


# --- flattening and checks -----------------------------------------------------------------------
@query
def normalize_orders(spark, sf):
    return flatten.normalize_orders(given.header_documents(spark, sf), INGESTED_AT)


@query
def normalize_order_items(spark, sf):
    return flatten.normalize_order_items(given.line_documents(spark, sf), INGESTED_AT, with_order_datetime=True)


@query
def items_with_order_datetime(spark, sf):
    counted = given.shop_orders(spark, sf).where(first_purchase.not_cancelled())
    return flatten.attach_order_datetime(given.shop_items(spark, sf), counted)


@query
def reject_report(spark, sf):
    headers, lines = given.header_documents(spark, sf, broken=True), given.line_documents(spark, sf, broken=True)
    return quality.reject_report(headers.unionByName(lines))


@query
def missing_orders(spark, sf):
    return quality.missing_orders(given.shop_orders(spark, sf), given.shop_items(spark, sf))


# --- sources and sinks ---------------------------------------------------------------------------
@query
def raw_orders_scan(spark, sf):
    path = scratch_path(spark, "raw")
    # single orders and responses of a hundred, as detail calls return them
    for part, batch in ((given.header_documents(spark, sf), DETAIL_BATCH), (given.line_documents(spark, sf), 1)):
        documents.write_order_documents(part, path, INGESTED_AT, batch)
    read = documents.read_order_documents(spark, path)
    return read.select(
        F.col("orderNumber").alias("order_number"),
        F.col("orderProgress").alias("order_progress"),
        F.col("OrdererModel.emailAddress").alias("user_email"),
        F.coalesce(F.size("PackageModelList"), F.lit(0)).alias("packages"),
        F.get("PackageModelList", F.lit(1))["ItemModelList"][0]["itemName"].alias("item_name"),
    )


@query
def order_numbers_dedup(spark, sf):
    return documents.found_order_numbers(given.search_pages(spark, sf))


@query
def detail_batches(spark, sf):
    return documents.detail_batches(documents.found_order_numbers(given.search_pages(spark, sf)))


@query
def product_master_clean(spark, sf):
    path = scratch_path(spark, "master")
    writer = given.master_cells(spark, sf).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return product_master.clean_master(master_files.read_master_csv(spark, path, multi_line=False))


@query
def product_master_grid(spark, sf):
    path = scratch_path(spark, "grid")
    given.master_grids(spark, sf).write.json(path)
    return product_master.clean_master(master_files.read_master_grid(spark, path))


EVENT_FILE = schemas.table(
    event_id=schemas.WHOLE, user_id=schemas.WHOLE, event_type=schemas.TEXT, value=schemas.NUMBER, ts=schemas.INSTANT
)
NOTES = ["exported by the shop", "all times are UTC", ";".join(EVENT_FILE.names)]


@query
def load_files(spark, sf):
    events = given.given(spark, sf, "events").withColumn("ts", given.utc("ts")).select(*EVENT_FILE.names)
    json_path, csv_path, noted_path = (scratch_path(spark, f"events-{kind}") for kind in ("json", "csv", "noted"))
    events.write.json(json_path)
    events.write.option("header", True).option("sep", ";").csv(csv_path)
    from_json = files.load_files(spark, json_path, schema=EVENT_FILE)
    from_csv = files.load_files(spark, csv_path, "CSV", schema=EVENT_FILE, field_delimiter=";", skip_leading_rows=1)
    # files with notes on top, written side by side
    line = F.concat_ws(";", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in EVENT_FILE.names])
    n_files = spark.sparkContext.defaultParallelism
    body = events.select(F.pmod(F.xxhash64("event_id"), F.lit(n_files)).cast("int").alias("file"), F.lit(len(NOTES)).alias("place"), line.alias("line"))
    notes = spark.range(n_files).select(F.col("id").cast("int").alias("file"), F.posexplode(F.array(*map(F.lit, NOTES))).alias("place", "line"))
    noted = notes.unionByName(body).repartition("file").sortWithinPartitions("file", "place")
    noted.select("file", "line").write.partitionBy("file").text(noted_path)
    from_noted = files.load_files(spark, noted_path, "CSV", schema=EVENT_FILE, field_delimiter=";", skip_leading_rows=len(NOTES))
    detected = files.load_files(spark, noted_path, "CSV", field_delimiter=";", skip_leading_rows=len(NOTES))
    if [kind for _, kind in detected.dtypes] != ["int", "int", "string", "double", "timestamp"]:
        raise ValueError(f"detected {detected.dtypes}")
    from_detected = detected.select(*[F.col(f.name).cast(f.dataType) for f in EVENT_FILE.fields])
    shown = from_json.withColumn("source_format", F.lit("NDJSON"))
    for name, rows in (("CSV", from_csv), ("CSV with notes", from_noted), ("CSV detected", from_detected)):
        shown = shown.unionByName(rows.withColumn("source_format", F.lit(name)))
    return shown


ORDER_FACTS = schemas.table(
    order_number=schemas.TEXT, order_datetime=schemas.INSTANT, order_status=schemas.TEXT, total_price=schemas.NUMBER
)


@query
def append_batch(spark, sf):
    path = f"{scratch_path(spark, 'house')}/orders"
    orders = given.shop_orders(spark, sf)
    schemas.ensure_table(spark, path, ORDER_FACTS, "order_month")
    for status in ("700", "300", "900", "100"):  # no order has the last one: an empty batch adds nothing
        batch = orders.where(F.col("order_status") == status)
        tables.load(spark, batch, path, ORDER_FACTS, partition="order_month", ts_column="order_datetime")
    return schemas.read_table(spark, path, ORDER_FACTS, "order_month")


@query
def delete_between(spark, sf):
    events = given.given(spark, sf, "events").select(
        "event_id", "event_type", F.when(F.col("event_type") != "error", given.utc("ts")).alias("at")
    )
    return merges.delete_between(events, "at", *DELETED).select("event_id", "event_type")


ITEM_FACTS = schemas.table(
    order_number=schemas.TEXT, variant_id=schemas.TEXT, subtotal=schemas.NUMBER, order_datetime=schemas.INSTANT
)


@query
def replace_month(spark, sf):
    orders = given.shop_orders(spark, sf)
    items = flatten.attach_order_datetime(given.shop_items(spark, sf), orders)
    # the range as fetched again: cancelled orders are gone, amounts moved, and some orders lie outside of it
    again = orders.where(merges.in_range("order_datetime", *REPLACED)).where(first_purchase.not_cancelled())
    again = again.unionByName(orders.where(merges.in_range("order_datetime", *STRAYS)))
    again = again.withColumn("total_price", F.col("total_price") + 1)
    items_again = items.where(merges.in_range("order_datetime", *REPLACED)).where("quantity > 10")

    shown, house = [], scratch_path(spark, "house")
    for name, schema, rows, incoming, amount in (
        ("orders", ORDER_FACTS, orders, again, "total_price"),
        ("order_items", ITEM_FACTS, items, items_again, "subtotal"),
    ):
        path = f"{house}/{name}"
        tables.load(spark, rows, path, schema, partition="order_month", ts_column="order_datetime")
        for _ in range(2):  # a second run changes nothing
            tables.replace_range(spark, path, schema, incoming, "order_datetime", *REPLACED)
        table = schemas.read_table(spark, path, schema, "order_month")
        shown.append(table.select(F.lit(name).alias("table_name"), "order_number", F.col(amount).alias("amount"), "order_month"))
    return shown[0].unionByName(shown[1])


@query
def upsert_by_keys(spark, sf):
    target = given.shop_orders(spark, sf).select("order_number", "order_status", "total_price")
    orders = given.given(spark, sf, "orders")
    number = F.col("o_orderkey").cast("string")
    cancelled = orders.where("o_orderstatus = 'P'").select(number.alias("order_number"), F.lit("950").alias("order_status"))
    new = orders.where("o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("new-"), number).alias("order_number"), F.lit("100").alias("order_status")
    )
    unnumbered = orders.where("o_orderpriority = '5-LOW'").select(
        F.lit(None).cast("string").alias("order_number"), F.col("o_orderstatus").alias("order_status")
    )
    return merges.upsert_by_keys(target, cancelled.unionByName(new).unionByName(unnumbered), ["order_number"])


@query
def upsert_table(spark, sf):
    path = f"{scratch_path(spark, 'house')}/orders"
    orders = given.shop_orders(spark, sf)
    tables.load(spark, orders, path, ORDER_FACTS, partition="order_month", ts_column="order_datetime")
    moved = orders.where("order_status = '900'").withColumn("order_status", F.lit("950"))
    urgent = given.given(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").cast("string").alias("order_number"))
    new = orders.join(urgent, "order_number", "left_semi").withColumn("order_number", F.concat(F.lit("new-"), "order_number"))
    new = new.withColumn("order_status", F.lit("100"))
    columns = ["order_number", "order_datetime", "order_status"]
    source = moved.select(*columns).unionByName(new.select(*columns))
    for _ in range(2):  # the second time, the new rows are known
        tables.upsert(spark, path, ORDER_FACTS, source, ["order_number"], "order_month", "order_datetime")
    return schemas.read_table(spark, path, ORDER_FACTS, "order_month").drop("order_datetime")


@query
def latest_documents(spark, sf):
    path = scratch_path(spark, "raw")
    headers = given.header_documents(spark, sf)
    documents.write_order_documents(headers.withColumn("orderProgress", F.lit("100")), path, INGESTED_AT)
    # the newer landing, in several files and in responses of several orders
    documents.write_order_documents(headers.where("orderProgress <> '300'").repartition(5), path, datetime(2024, 2, 20), DETAIL_BATCH)
    kept = documents.first_documents(stage(spark, documents.read_order_documents(spark, path), "documents"))
    return kept.select(F.col("orderNumber").alias("order_number"), F.col("orderProgress").alias("order_progress"))


# --- jobs on written tables, read back -----------------------------------------------------------
@query
def job_load_span(spark, sf):
    """Documents landed twice, loaded twice: orders and items of every month, one document per order line."""
    raw, house = scratch_path(spark, "raw"), jobs.Warehouse(scratch_path(spark, "house"))
    house.create(spark)
    lines = given.line_documents(spark, sf)
    for day in (INGESTED_AT, datetime(2024, 3, 1)):
        documents.write_order_documents(lines, raw, day)
    for _ in range(2):
        jobs.load_span(spark, house, documents.read_order_documents(spark, raw), *ALL_TIME, run_at=INGESTED_AT)
    orders = house.read(spark, "orders").select(F.lit("orders").alias("table_name"), "order_number", F.lit(None).cast("string").alias("item_id"), "order_month")
    items = house.read(spark, "order_items").select(F.lit("order_items").alias("table_name"), "order_number", "item_id", "order_month")
    return orders.unionByName(items)


def _facts(spark, sf) -> dict[str, tuple[DataFrame, dict]]:
    """Orders and order lines with their times, and the columns that their tables make of them."""
    stamp = {"inserted_at": F.lit(str(INGESTED_AT)).cast("timestamp")}
    orders = given.shop_orders(spark, sf)
    items = given.item_columns()
    return {
        "orders": (orders, stamp),
        "order_items": (given.timed_lines(spark, sf, orders), {**items, "item_id": items["variant_id"], **stamp}),
    }


def _house(spark, sf) -> jobs.Warehouse:
    """A warehouse with the shop's orders, items and master."""
    house = jobs.Warehouse(scratch_path(spark, "house"))
    house.create(spark)
    for name, (rows, derived) in _facts(spark, sf).items():
        tables.load(
            spark, rows, house.path(name), house.SCHEMAS[name], partition="order_month", ts_column="order_datetime", derived=derived
        )
    return house


def _cohorts(spark, house):
    return house.read(spark, "entry_product_ltv_by_month_offset").drop("updated_at")


@query
def job_initial_load(spark, sf):
    """Master sync, then first purchases and cohorts over all history, written and read back."""
    house = _house(spark, sf)
    jobs.sync_master(spark, house, given.shop_master(spark, sf), required=True)
    for _ in range(2):
        jobs.initial_load(spark, house, INGESTED_AT)
    return _cohorts(spark, house)


@query
def job_refresh_names(spark, sf):
    """Cohorts named by an older master, and then by the newer one."""
    house = _house(spark, sf)
    master = given.shop_master(spark, sf)
    jobs.sync_master(spark, house, master.where("cast(brand_name as int) <= 25"), required=True)
    jobs.initial_load(spark, house, INGESTED_AT)
    jobs.sync_master_and_names(spark, house, master)
    return _cohorts(spark, house).select("entry_manage_number", "entry_item_name", "first_order_month", "month_offset", "cohort_users", "category_name", "brand_name")


# the last business months of the given orders, loaded one by one after the others
LAST_MONTHS = [datetime(2001, month, 1) for month in (6, 7, 8)]


@query
def job_refresh_cohorts(spark, sf):
    """All history but three months in one load, then each month on its own: new users merged, cohorts kept up to date."""
    house = jobs.Warehouse(scratch_path(spark, "house"))
    house.create(spark)
    jobs.sync_master(spark, house, given.shop_master(spark, sf), required=True)
    facts = _facts(spark, sf)
    # every load reads the items, which are joined once
    facts["order_items"] = stage(spark, facts["order_items"][0], "timed-items", codec="zstd"), facts["order_items"][1]
    early = F.col("order_datetime") < F.lit(iso_instant(LAST_MONTHS[0])).cast("timestamp")
    for name, (rows, derived) in facts.items():
        tables.load(
            spark, rows.where(early), house.path(name), house.SCHEMAS[name], partition="order_month", ts_column="order_datetime", derived=derived
        )
    jobs.initial_load(spark, house, INGESTED_AT)
    for start in LAST_MONTHS:
        end = shift_month(start, 1)
        inside = merges.in_range("order_datetime", iso_instant(start), iso_instant(end))
        incoming = {house.path(name): (house.SCHEMAS[name], rows.where(inside).withColumns(derived)) for name, (rows, derived) in facts.items()}
        tables.replace_ranges(spark, incoming, "order_datetime", iso_instant(start), iso_instant(end))
        jobs.merge_first_purchases(spark, house, start, run_at=INGESTED_AT)
        jobs.refresh_ltv(spark, house, [start.date()], INGESTED_AT)
    return _cohorts(spark, house)


@query
def job_follow_landings(spark, sf):
    """Documents that land in two steps, responses of a hundred orders, brought into the tables by a stream after each."""
    raw, checkpoint, house = scratch_path(spark, "raw"), scratch_path(spark, "checkpoint"), jobs.Warehouse(scratch_path(spark, "house"))
    house.create(spark)
    headers = given.header_documents(spark, sf)
    steps = (headers.withColumn("orderProgress", F.lit("100")), INGESTED_AT), (headers.where("orderProgress <> '300'"), datetime(2024, 3, 1))
    for rows, day in steps:
        documents.write_order_documents(rows, raw, day, DETAIL_BATCH)
        landing.follow_landings(spark, house, raw, checkpoint, run_at=INGESTED_AT).awaitTermination()
    return house.read(spark, "orders").select("order_number", "order_status", "total_price", "order_month")


@query
def job_merge_month(spark, sf):
    """First purchases of one month, merged into a table that knows nobody, and merged again."""
    house = _house(spark, sf)
    jobs.sync_master(spark, house, given.shop_master(spark, sf), required=True)
    for _ in range(2):
        jobs.merge_first_purchases(spark, house, datetime.fromisoformat(MERGE_MONTH), run_at=INGESTED_AT)
    return house.read(spark, "user_first_purchase_info").select(*first_purchase.FIRST_PURCHASE_COLUMNS)


RUNS = {"MONTHLY": {}, "HISTORICAL": {}, "CUSTOM": {"start": "1995-01-15", "end": "1995-06-09"}}


@query
def job_dry_run(spark, sf):
    """The order numbers that a run of each mode would load, range by range."""
    orders = given.shop_orders(spark, sf)
    shown = [
        jobs.dry_run(spark, orders, mode, now=datetime(1997, 3, 15, 12), **span).select(F.lit(mode).alias("mode"), "range_start", "range_end", "order_numbers")
        for mode, span in RUNS.items()
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


# --- calendar, ranges and reports ----------------------------------------------------------------
@query
def business_calendar(spark, sf):
    at = given.utc("ts")
    day = business_date(at)
    return given.given(spark, sf, "events").select(
        "event_id",
        day.alias("business_day"),
        month_of(day).alias("month_start"),
        F.add_months(month_of(day), 1).alias("next_month"),
        F.add_months(month_of(day), -1).alias("prev_month"),
        iso_local(at).alias("iso_plain"),
        iso_local(at, colon=True).alias("iso_colon"),
    )


@query
def month_ranges(spark, sf):
    orders = given.shop_orders(spark, sf)
    spans = orders.groupBy("user_email").agg(F.min("order_datetime").alias("a"), F.max("order_datetime").alias("b"))
    local = spans.select(
        "user_email",
        business_date(F.col("a")).cast("timestamp_ntz").alias("start"),
        F.date_add(business_date(F.col("b")), 1).cast("timestamp_ntz").alias("end"),
    )
    return ranges.monthly_ranges(local)


def _whole_span(spark, sf):
    orders = given.shop_orders(spark, sf)
    return orders, ranges.monthly_ranges(ranges.order_span(orders))


@query
def range_order_counts(spark, sf):
    return ranges.order_counts(*_whole_span(spark, sf))


@query
def chunk_counts(spark, sf):
    return ranges.chunk_counts(*_whole_span(spark, sf))


@query
def backfill_plan(spark, sf):
    return ranges.backfill_load(*_whole_span(spark, sf))


@query
def run_summary(spark, sf):
    return ranges.run_totals(ranges.order_counts(*_whole_span(spark, sf)))


@query
def orders_by_month(spark, sf):
    return reports.orders_by_month(given.shop_orders(spark, sf))


@query
def table_freshness(spark, sf):
    orders = given.given(spark, sf, "orders").select(given.utc("o_orderdate").alias("inserted_at"))
    lines = given.given(spark, sf, "lineitem").select(given.utc("l_shipdate").alias("inserted_at"))
    return reports.table_freshness(orders, "orders", "inserted_at").unionByName(
        reports.table_freshness(lines, "order_items", "inserted_at")
    )


@query
def product_sales(spark, sf):
    return reports.product_sales(given.shop_items(spark, sf), _names(spark, sf))
