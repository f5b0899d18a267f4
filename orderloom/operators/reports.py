"""Reports on the tables: orders per month, freshness, sales per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import business_month
from orderloom.functions.scalars import money
from orderloom.operators.product_master import longest


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Orders per business month, as yyyy-MM in rising order. The months are counted as dates and
    named afterwards."""
    counts = orders.groupBy(business_month(F.col("order_datetime")).alias("day")).agg(
        F.count(F.lit(1)).alias("order_count")
    )
    return counts.select(F.date_format("day", "yyyy-MM").alias("month"), "order_count").orderBy("month")


def table_freshness(rows: DataFrame, table: str, stamp: str) -> DataFrame:
    """When a table was last written, and how many rows it has."""
    return rows.agg(F.max(stamp).alias("last_written"), F.count(F.lit(1)).alias("total_rows")).select(
        F.lit(table).alias("table_name"), "last_written", "total_rows"
    )


def product_sales(items: DataFrame, names: DataFrame) -> DataFrame:
    """Quantity, sales and orders per product, named by the master first.

    Sums go per product and order first, where each order is a row, and then per product: a bestseller crosses the
    network as a row per order and task, then as a few rows. Item names are made distinct on their own before the longest
    is looked for, so that the sums are hashed and not sorted.
    """
    per_order = items.groupBy("manage_number", "order_number").agg(
        F.sum("quantity").alias("quantity"), F.sum(money(F.col("subtotal"))).alias("sales")
    )
    sums = per_order.groupBy(F.col("manage_number").alias("number")).agg(
        F.sum("quantity").cast("bigint").alias("quantity"), F.sum("sales").cast("double").alias("sales"), F.count("order_number").alias("orders")
    )
    carried = items.select("manage_number", "item_name").distinct().groupBy("manage_number").agg(longest("item_name").alias("item_name"))
    both = sums.join(carried, F.col("number").eqNullSafe(F.col("manage_number")))
    return both.join(names, "manage_number", "left").select(
        "manage_number",
        F.coalesce("product_name", "item_name").alias("item_name"),
        "category_name",
        "brand_name",
        "quantity",
        "sales",
        "orders",
    )
