"""Cleaning the product master and choosing one name per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.scalars import blank_to_null, stripped

# Headers of the master sheet and the columns they fill.
HEADERS = {
    "商品管理番号": "manage_number",
    "商品名": "product_name",
    "カテゴリ名": "category_name",
    "ブランド名": "brand_name",
}


def clean_master(raw: DataFrame) -> DataFrame:
    """The four master columns, stripped, blanks as null, each distinct row with a manage_number once."""

    def column(header: str, name: str) -> Column:
        source = header if header in raw.columns else name
        value = F.col(f"`{source}`") if source in raw.columns else F.lit(None)
        return stripped(value).alias(name)

    rows = raw.select(*[column(header, name) for header, name in HEADERS.items()])
    return rows.where(F.col("manage_number").isNotNull()).distinct()


def longest(text: str) -> Column:
    """The longest non-blank text of a group; of equally long ones the greatest. All blank gives null."""
    value = blank_to_null(F.col(text))
    return F.max_by(value, F.when(value.isNotNull(), F.struct(F.length(value), value)))


def best_names(master: DataFrame) -> DataFrame:
    """One row per manage_number; name, category and brand are chosen independently."""
    return master.groupBy("manage_number").agg(
        longest("product_name").alias("product_name"),
        longest("category_name").alias("category_name"),
        longest("brand_name").alias("brand_name"),
    )
