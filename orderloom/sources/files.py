"""Loading newline-delimited JSON and CSV files."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import scratch_path


def load_files(
    spark: SparkSession,
    paths: str | list[str],
    source_format: str = "NEWLINE_DELIMITED_JSON",
    autodetect: bool = True,
    schema: T.StructType | None = None,
    field_delimiter: str = ",",
    skip_leading_rows: int = 0,
) -> DataFrame:
    """Files as a frame. A given schema switches detection off.

    With a schema, CSV columns go by position and ``skip_leading_rows`` rows are left out at the top
    of each file. Without one, the last of those rows names the columns, the first row if none is to be skipped.
    """
    if schema is None and not autodetect:
        raise ValueError("give a schema or allow autodetect")
    if source_format == "NEWLINE_DELIMITED_JSON":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.option("mode", "FAILFAST").json(paths)
    if source_format != "CSV":
        raise ValueError(f"unknown source format {source_format!r}")

    reader = spark.read.option("sep", field_delimiter).option("quote", '"').option("escape", '"')
    if schema is None and skip_leading_rows > 1:
        return _detected_after_rows(spark, paths, field_delimiter, skip_leading_rows)
    if schema is None:
        return reader.option("header", True).option("inferSchema", True).csv(paths)
    if skip_leading_rows <= 1:
        return reader.schema(schema).option("header", skip_leading_rows == 1).option("mode", "FAILFAST").csv(paths)
    return _csv_after_rows(spark, paths, schema, field_delimiter, skip_leading_rows)


def _numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines of some files with their file and their number in it, however the files are cut into blocks.

    Line ids rise by one within a block. A line's number in its file is its place in the block and the lines of
    the file's earlier blocks, of which there is one row each.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("file", "block")
        .agg(F.min("line_id").alias("first_id"), F.count(F.lit(1)).alias("lines"))
        .withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))
    )
    numbered = lines.join(blocks, ["file", "block"])
    return numbered.select("value", "file", (F.col("before") + F.col("line_id") - F.col("first_id")).alias("number"))


def _csv_after_rows(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, delimiter: str, skip: int
) -> DataFrame:
    """CSV with more than one row to leave out at the top of each file."""
    body = _numbered_lines(spark, paths).where(F.col("number") >= skip).where("value != ''")
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("value", columns, {"sep": delimiter, "quote": '"', "escape": '"', "mode": "FAILFAST"})
    return body.select(parsed.alias("row")).select("row.*")


def _detected_after_rows(spark: SparkSession, paths: str | list[str], delimiter: str, skip: int) -> DataFrame:
    """CSV whose last row to leave out names the columns. What is below is staged as lines, and Spark detects the types from
    all of them. Files that name other columns, or the same in another order, stop the read."""
    lines = _numbered_lines(spark, paths)
    heads = [row[0] for row in lines.where(F.col("number") == skip - 1).select("value").distinct().limit(2).collect()]
    if len(heads) != 1:
        raise ValueError("the files name no columns" if not heads else f"the files name different columns: {heads}")
    options = {"sep": delimiter, "quote": '"', "escape": '"'}
    width = len(next(csv.reader(heads, delimiter=delimiter)))
    texts = ", ".join(f"c{k} string" for k in range(width))
    names = spark.createDataFrame([(heads[0],)], "value string").select(F.from_csv("value", texts, options).alias("n")).select("n.*").first()
    body = scratch_path(spark, "csv-body")
    lines.where(F.col("number") >= skip).where("value != ''").select("value").write.text(body)
    return spark.read.options(**options).option("inferSchema", True).option("mode", "FAILFAST").csv(body).toDF(*names)
