"""Each user's first order and the product that brought them in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import business_date, month_of
from orderloom.operators.merges import unmatched

CANCELLED = ("900",)  # fixed value: cancellation confirmed; a pending one still counts as a sale

MARKS = 1 << 26  # bits that tell items of first orders from most others: a million words of 64 at most

FIRST_PURCHASE_COLUMNS = [
    "user_email", "first_order_number", "first_order_date", "first_order_month",
    "entry_manage_number", "entry_item_name",
]


def not_cancelled(cancelled: Sequence[str] = CANCELLED) -> Column:
    """Orders that count. An order without a status does not."""
    status = F.col("order_status")
    return status.isNotNull() & ~status.isin(*cancelled)


def base_orders(orders: DataFrame, cancelled: Sequence[str] = CANCELLED) -> DataFrame:
    """Orders that count, with their business day and month."""
    day = business_date(F.col("order_datetime"))
    return orders.where(not_cancelled(cancelled)).select(
        "order_number",
        "user_email",
        "order_datetime",
        "total_price",
        day.alias("order_date"),
        month_of(day).alias("order_month"),
    )


def first_orders(orders: DataFrame, cancelled: Sequence[str] = CANCELLED) -> DataFrame:
    """The earliest order of each user, by time and then order number.

    A minimum over (time, number) leaves at most one row per user and task before the shuffle, so a user
    with very many orders costs no more than any other. Orders without a user are left out: the table
    this feeds requires one.
    """
    counted = orders.where(not_cancelled(cancelled) & F.col("user_email").isNotNull())
    first = counted.groupBy("user_email").agg(F.min(F.struct("order_datetime", "order_number")).alias("first"))
    day = business_date(F.col("first.order_datetime"))
    return first.select(
        "user_email",
        F.col("first.order_number").alias("first_order_number"),
        day.alias("first_order_date"),
        month_of(day).alias("first_order_month"),
    )


def in_months(first: DataFrame, month: str, until: str | None = None) -> DataFrame:
    """Users whose very first order falls into ``[month, until)``, one month unless ``until`` is given.

    This comes after the minimum, since filtering orders before it would turn a later order into a
    first one.
    """
    start = F.lit(month).cast("date")
    end = F.lit(until).cast("date") if until else F.add_months(start, 1)
    return first.where((F.col("first_order_month") >= start) & (F.col("first_order_month") < end))


def entry_items(items: DataFrame) -> DataFrame:
    """Per order the item with the greatest subtotal, then the smallest manage_number, then item name.

    One row per order and task is left to shuffle, however many items an order holds.
    """
    rank = F.struct(
        F.col("subtotal").isNull().alias("unpriced"),
        (-F.col("subtotal")).alias("falling"),
        "manage_number",
        "item_name",
    )
    best = items.where(F.col("manage_number").isNotNull()).groupBy("order_number").agg(F.min(rank).alias("best"))
    return best.select("order_number", "best.manage_number", "best.item_name")


def _marked_items(items: DataFrame, numbers: DataFrame) -> DataFrame:
    """The items of ``numbers`` and few others: those whose order number falls on one of the bits that the numbers set.

    Words of 64 bits are broadcast, never more than ``MARKS`` bits, however many numbers there are.
    """
    place = F.pmod(F.xxhash64("order_number"), F.lit(MARKS))
    bit = place.bitwiseAND(63).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    marks = numbers.groupBy(F.shiftright(place, 6).alias("_word")).agg(F.bit_or(one).alias("_marks"))
    placed = items.withColumn("_word", F.shiftright(place, 6)).join(F.broadcast(marks), "_word")
    return placed.where(F.getbit("_marks", bit) == 1).select(*items.columns)


def entry_products(first: DataFrame, items: DataFrame, names: DataFrame) -> DataFrame:
    """First orders with their entry product, named by the master where it has a name.

    Users whose first order has no item with a manage_number drop out. Most items of other orders leave by their marks before
    the best one is chosen: a user has one first order, and the history holds many more items than first orders have. The others
    leave with the join. A semi join in its place would be pushed below the marks, and shuffle all items.
    """
    numbers = first.select(F.col("first_order_number").alias("order_number"))
    best = entry_items(_marked_items(items, numbers)).withColumnRenamed("order_number", "first_order_number")
    entered = first.join(best, "first_order_number")
    named = entered.join(names, "manage_number", "left")
    return named.select(
        "user_email",
        "first_order_number",
        "first_order_date",
        "first_order_month",
        F.col("manage_number").alias("entry_manage_number"),
        F.coalesce("product_name", "item_name").alias("entry_item_name"),
        "category_name",
        "brand_name",
    )


def first_purchases(
    orders: DataFrame, items: DataFrame, names: DataFrame, cancelled: Sequence[str] = CANCELLED
) -> DataFrame:
    """All users over the full history. Category and brand are not stored in this table."""
    return entry_products(first_orders(orders, cancelled), items, names).select(*FIRST_PURCHASE_COLUMNS)


def new_first_purchases(
    orders: DataFrame,
    items: DataFrame,
    names: DataFrame,
    known: DataFrame,
    month: str,
    until: str | None = None,
    cancelled: Sequence[str] = CANCELLED,
) -> DataFrame:
    """The rows a merge inserts: users new in ``[month, until)`` that ``known`` does not hold yet.

    A known user is never changed, whatever their orders say now. Known users leave before the items are
    joined.
    """
    fresh = unmatched(in_months(first_orders(orders, cancelled), month, until), known, ["user_email"])
    return entry_products(fresh, items, names).select(*FIRST_PURCHASE_COLUMNS)
