"""The product master as a CSV file or as the value grid of a sheet; every cell is text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.product_master import HEADERS

# Cell texts that a CSV of the master uses for "no value".
MISSING_MARKS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

GRID = T.StructType([T.StructField("values", T.ArrayType(T.ArrayType(T.StringType())))])


def read_master_csv(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Columns as the file names them. ``multi_line`` allows line breaks inside quotes, and keeps each
    file in one task; switch it off for large files without such breaks so that they are split."""
    raw = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(paths)
    )
    return raw.select(
        *[F.when(~F.col(f"`{c}`").isin(MISSING_MARKS), F.col(f"`{c}`")).alias(c) for c in raw.columns]
    )


def read_master_grid(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    """Landed ``{"values": [[header...], [cell...], ...]}`` objects as master columns."""
    grids = spark.read.schema(GRID).option("mode", "FAILFAST").option("multiLine", multi_line).json(paths)
    return grid_rows(grids)


def grid_rows(grids: DataFrame) -> DataFrame:
    """The rows below each header row; a short row gives null, cells beyond the header are dropped.

    Columns are found by header text, so the header may differ from object to object.
    """
    rows = grids.where(F.size("values") > 1).select(
        F.get("values", F.lit(0)).alias("header"),
        F.explode(F.slice("values", F.lit(2), F.size("values"))).alias("cells"),
    )

    def column(header: str, name: str):
        place = F.coalesce(
            F.nullif(F.array_position("header", header), F.lit(0)),
            F.nullif(F.array_position("header", name), F.lit(0)),
        )
        return F.get("cells", (place - 1).cast("int")).alias(name)

    return rows.select(*[column(header, name) for header, name in HEADERS.items()])
