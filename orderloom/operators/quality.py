"""What a load must not contain: reject reasons, their counts, and orders that were never fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.scalars import blank_to_null, to_instant
from orderloom.operators.flatten import item_entries


def _order_rules() -> dict[str, Column]:
    placed = blank_to_null(F.col("orderDatetime"))
    return {
        "order_number_missing": F.col("orderNumber").isNull(),
        "order_datetime_missing": placed.isNull(),
        "order_datetime_unreadable": placed.isNotNull() & to_instant(placed).isNull(),
    }


def _item_rules() -> dict[str, Column]:
    return {"item_id_missing": F.col("item.itemId").isNull()}


def _counted(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule from a single pass over ``rows``."""
    totals = rows.agg(
        F.count(F.lit(1)).alias("checked"), *[F.count_if(bad).alias(name) for name, bad in rules.items()]
    )
    per_rule = [
        F.struct(F.lit(name).alias("rule"), F.col("checked"), F.col(name).alias("rejected")) for name in rules
    ]
    return totals.select(F.inline(F.array(*per_rule)))


def reject_report(documents: DataFrame) -> DataFrame:
    """How many orders and items were checked, and how many break each rule."""
    return _counted(documents, _order_rules()).unionByName(_counted(item_entries(documents), _item_rules()))


def split_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents fit to load, and the others with the rules they break in ``reject_reasons``."""
    item_missing = F.exists(
        F.filter("PackageModelList", lambda package: package["ItemModelList"].isNotNull()),
        lambda package: F.exists(package["ItemModelList"], lambda item: item["itemId"].isNull()),
    )
    rules = {**_order_rules(), "item_id_missing": F.coalesce(item_missing, F.lit(False))}
    reasons = F.filter(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]), lambda name: name.isNotNull()
    )
    marked = documents.withColumn("reject_reasons", reasons)
    fit = marked.where(F.size("reject_reasons") == 0).drop("reject_reasons")
    return fit, marked.where(F.size("reject_reasons") > 0)


def missing_orders(searched: DataFrame, fetched: DataFrame) -> DataFrame:
    """Order numbers that a search listed and no fetched document holds."""
    have = fetched.select("order_number").distinct()
    return searched.select("order_number").distinct().join(have, "order_number", "left_anti")
