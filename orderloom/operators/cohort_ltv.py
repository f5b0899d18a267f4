"""Lifetime value of cohorts: users by entry product and first month, followed over the months after."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.calendar import business_month, months_apart
from orderloom.functions.scalars import blank_to_null, money
from orderloom.operators.first_purchase import CANCELLED, not_cancelled
from orderloom.session import stage

COHORT = ["entry_manage_number", "first_order_month"]
SHOWN = ["entry_manage_number", "entry_item_name", "category_name", "brand_name"]


def _monthly_sales(orders: DataFrame, cancelled: Sequence[str]) -> DataFrame:
    """Exact sales per user and business month; partial sums leave before the shuffle."""
    counted = orders.where(not_cancelled(cancelled)).select(
        "user_email", business_month(F.col("order_datetime")).alias("order_month"), money(F.col("total_price")).alias("paid")
    )
    return counted.groupBy("user_email", "order_month").agg(F.sum("paid").alias("monthly_sales"))


def user_monthly_sales(orders: DataFrame, cancelled: Sequence[str] = CANCELLED) -> DataFrame:
    return _monthly_sales(orders, cancelled).withColumn("monthly_sales", F.col("monthly_sales").cast("double"))


def named_cohorts(first: DataFrame, names: DataFrame) -> DataFrame:
    """Users with their cohort and the entry product's name as the master has it today."""
    current = names.select(F.col("manage_number").alias("entry_manage_number"), "product_name")
    return (
        first.select("user_email", *COHORT, "entry_item_name")
        .join(current, "entry_manage_number", "left")
        .select("user_email", *COHORT, F.coalesce("product_name", "entry_item_name").alias("entry_item_name"))
    )


def _labelled(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Category and brand hang on the product alone, so they join after grouping and are no group keys."""
    labels = names.select(F.col("manage_number").alias("entry_manage_number"), "category_name", "brand_name")
    others = [c for c in rows.columns if c not in SHOWN]
    return rows.join(labels, "entry_manage_number", "left").select(*SHOWN, *others)


def _cohort_sales(cohorts: DataFrame, sales: DataFrame) -> DataFrame:
    """Users' months of sales from their first month on, counted in months since then."""
    offset = months_apart(F.col("order_month"), F.col("first_order_month"))
    followed = cohorts.join(sales, "user_email").withColumn("month_offset", offset)
    return followed.where("month_offset >= 0").drop("order_month")


def user_cohort_sales(
    first: DataFrame, orders: DataFrame, names: DataFrame, cancelled: Sequence[str] = CANCELLED
) -> DataFrame:
    """Sales of each user per month since their first order."""
    rows = _labelled(_cohort_sales(named_cohorts(first, names), _monthly_sales(orders, cancelled)), names)
    return rows.withColumn("monthly_sales", F.col("monthly_sales").cast("double"))


def _members(first: DataFrame, names: DataFrame) -> DataFrame:
    """Each user of a cohort and name once, with the number of rows that say so.

    Users are counted from here on, so no later step needs a distinct count.
    """
    cohorts = named_cohorts(first, names)
    return cohorts.groupBy("user_email", *COHORT, "entry_item_name").agg(
        F.count(F.lit(1)).cast("decimal(10,0)").alias("entries")
    )


def _sizes(members: DataFrame) -> DataFrame:
    by_name = members.groupBy("entry_manage_number", "entry_item_name", "first_order_month")
    return by_name.agg(F.count("user_email").alias("cohort_users"))


def cohort_counts(first: DataFrame, names: DataFrame) -> DataFrame:
    """Users per product, names and first month; null names form one group."""
    return _labelled(_sizes(_members(first, names)), names)


def _sums(members: DataFrame, orders: DataFrame, cancelled: Sequence[str]) -> DataFrame:
    """Buyers and exact revenue per cohort, name and offset.

    Sales hold a user's month once, so the rows of a group are its buyers.
    """
    followed = _cohort_sales(members, _monthly_sales(orders, cancelled))
    return followed.groupBy("entry_manage_number", "entry_item_name", "first_order_month", "month_offset").agg(
        F.count(F.lit(1)).alias("active_buyers"), F.sum(F.col("monthly_sales") * F.col("entries")).alias("revenue")
    )


def _equal_sizes(members: DataFrame) -> DataFrame:
    """The cohort sizes of a product and month, and how many names have each."""
    copies = F.count(F.lit(1)).cast("decimal(10,0)").alias("copies")
    return _sizes(members).groupBy(*COHORT, "cohort_users").agg(copies)


def _spread(sums: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sums against the sizes of their cohort.

    Cohort sizes are counted per name but meet the sales by product and month only, so a product sold
    under several names in one month repeats its revenue once per name, and rows of equal size fall into
    one group. Multiplying the sums by the number of equal sizes gives the same figures without repeating
    a single user row.
    """
    return sums.join(sizes, COHORT).withColumn("revenue", F.col("revenue") * F.col("copies")).drop("copies")


def _running(rows: DataFrame) -> DataFrame:
    """Running revenue per cohort and offset; all rows of an offset share it.

    One row per offset enters the window, however many names a product was sold under.
    """
    paid = rows.groupBy(*COHORT, "month_offset").agg(F.sum("revenue").alias("paid"))
    running = F.sum("paid").over(Window.partitionBy(*COHORT).orderBy("month_offset"))
    return paid.select(*COHORT, "month_offset", running.alias("running"))


def _shown(rows: DataFrame) -> DataFrame:
    """The cohort table from its rows with exact revenue. The rows are read twice."""
    rows = rows.join(_running(rows), [*COHORT, "month_offset"])
    revenue, cumulative = F.col("revenue").cast("double"), F.col("running").cast("double")
    return rows.select(
        *SHOWN,
        "first_order_month",
        "month_offset",
        "cohort_users",
        "active_buyers",
        revenue.alias("revenue_in_month"),
        cumulative.alias("cumulative_revenue"),
        F.try_divide(cumulative, F.col("cohort_users")).alias("ltv_per_user"),
        F.try_divide(revenue, F.col("active_buyers")).alias("aov_in_month"),
    )


def ltv_monthly_aggregated(
    first: DataFrame, orders: DataFrame, names: DataFrame, cancelled: Sequence[str] = CANCELLED
) -> DataFrame:
    members = _members(first, names)
    rows = _labelled(_spread(_sums(members, orders, cancelled), _equal_sizes(members)), names)
    return rows.withColumn("revenue_in_month", F.col("revenue").cast("double")).drop("revenue")


def ltv_by_month_offset(
    first: DataFrame, orders: DataFrame, names: DataFrame, cancelled: Sequence[str] = CANCELLED
) -> DataFrame:
    """The cohort table: size, buyers, revenue, running revenue, value per user and per buyer.

    The sums are staged in the shared folder: they are far smaller than the users' months they come from,
    and both the rows and the running revenue are made of them.
    """
    members = _members(first, names)
    sums = _sums(members, orders, cancelled).where("active_buyers > 0 or revenue > 0")
    sums = stage(first.sparkSession, sums, "cohort-sums")
    return _shown(_labelled(_spread(sums, _equal_sizes(members)), names))


def changed_cohorts(
    held: DataFrame, first: DataFrame, orders: DataFrame, names: DataFrame, months: Sequence[date], cancelled: Sequence[str] = CANCELLED
) -> tuple[DataFrame, list[date]]:
    """What the cohort table holds after the orders or new users of some months changed, and the first months it changes in.

    A month of orders is one offset of a cohort, and the table itself holds the sums of all offsets. So older cohorts get new
    sums for the offsets of the changed months alone, from the orders of those months; the others are taken over, and only the running
    revenue is made again. Cohorts that begin in a changed month may have got users, and are summed from there on. First months without
    a buyer in the changed months are not read or written.

    ``orders`` needs its order_month, by which other months are pruned. Users known before the changed months must be the
    same as when ``held`` was made, and so must the names; else the table has to be built anew.
    """
    spark = held.sparkSession
    days = [F.lit(str(month)).cast("date") for month in sorted(months)]
    young = F.col("first_order_month").isin(*days)
    members = _members(first.where(F.col("first_order_month") <= days[-1]), names)
    month = F.col("order_month")
    older = _sums(members.where(~young), orders.where(month.isin(*days)), cancelled)
    sums = older.unionByName(_sums(members.where(young), orders.where(month >= days[0]), cancelled))
    sums = stage(spark, sums.where("active_buyers > 0 or revenue > 0"), "changed-sums")

    gone = young | F.add_months("first_order_month", F.col("month_offset").cast("int")).isin(*days)
    touched = sums.select("first_order_month").unionByName(held.where(gone).select("first_order_month"))
    touched = sorted(row[0] for row in touched.distinct().collect())  # one per month
    inside = F.col("first_order_month").isin(*[F.lit(str(m)).cast("date") for m in touched]) if touched else F.lit(False)
    fresh = _labelled(_spread(sums, _equal_sizes(members.where(inside))), names)
    kept = held.where(inside & ~gone).withColumn("revenue", money(F.col("revenue_in_month"))).select(*fresh.columns)
    rows = stage(spark, kept.unionByName(fresh), "changed-cohorts")
    return _shown(rows), touched


def _one_name(first: DataFrame, names: DataFrame) -> DataFrame:
    """A single name per product: the master's, else the longest the first purchases carry."""
    carried = blank_to_null(F.col("entry_item_name"))
    longest = F.max_by(carried, F.when(carried.isNotNull(), F.struct(F.length(carried), carried)))
    own = first.groupBy(F.col("entry_manage_number").alias("manage_number")).agg(longest.alias("carried_name"))
    return own.join(names, "manage_number", "left").select(
        "manage_number",
        F.coalesce("product_name", "carried_name").alias("product_name"),
        "category_name",
        "brand_name",
    )


def ltv_canonical(
    first: DataFrame, orders: DataFrame, names: DataFrame, cancelled: Sequence[str] = CANCELLED
) -> DataFrame:
    """The cohort table with one row per product, first month and offset: no revenue is counted twice."""
    return ltv_by_month_offset(first, orders, _one_name(first, names), cancelled)


def changed(new: str = "new_") -> Column:
    """Whether a row's names differ from the master's. A null name on either side is no difference by
    itself; categories and brands compare with null as blank."""

    def blank(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    differs = F.col("entry_item_name") != F.col(f"{new}product_name")
    for name in ("category_name", "brand_name"):
        differs = differs | (blank(name) != blank(f"{new}{name}"))
    return F.coalesce(differs, F.lit(False))


def refreshed_names(ltv: DataFrame, items: DataFrame, names: DataFrame) -> DataFrame:
    """Cohort rows with the master's names, and ``name_changed``; only products that were ever sold and
    are in the master change. Items are reduced to their product keys before any shuffle."""
    sold = items.select(F.col("manage_number").alias("entry_manage_number")).distinct()
    current = names.select(
        F.col("manage_number").alias("entry_manage_number"),
        *[F.col(c).alias(f"new_{c}") for c in ("product_name", "category_name", "brand_name")],
        F.lit(True).alias("in_master"),
    ).join(sold, "entry_manage_number", "left_semi")
    joined = ltv.join(current, "entry_manage_number", "left")
    update = F.coalesce("in_master", F.lit(False)) & changed()
    sources = {"entry_item_name": "new_product_name", "category_name": "new_category_name", "brand_name": "new_brand_name"}
    return joined.withColumn("name_changed", update).select(
        *[
            F.when(F.col("name_changed"), F.col(sources[c])).otherwise(F.col(c)).alias(c) if c in sources else F.col(c)
            for c in ltv.columns
        ],
        "name_changed",
    )
