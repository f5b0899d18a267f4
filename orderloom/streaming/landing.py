"""The landing folder as a stream: each new file's orders and items reach the tables once.

A micro-batch replaces the rows of the orders that it holds, so running it again gives the same tables. The number of the last
batch is kept with the orders table, and a batch that comes again after it was noted is passed over.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom import schemas, tabled
from orderloom.operators import flatten, quality, tables
from orderloom.plans.jobs import Warehouse
from orderloom.session import pin_utc, scratch
from orderloom.sources.documents import landed_orders, response_reader, staged_once


def apply_batch(
    spark: SparkSession, house: Warehouse, documents: DataFrame, batch: int, stream: str = "landing", run_at: datetime | None = None,
    quarantine: str | None = None,
) -> bool:
    """Bring the orders of a batch into the tables: False if the stream has brought this batch before.

    One document per order number counts, of the newest landing in the batch; a later batch counts more than an earlier one.
    Documents that fail the checks stop the batch, or go to the folder ``quarantine`` as JSON.
    """
    pin_utc(spark)
    key, orders_path, items_path = f"stream.{stream}.batch", house.path("orders"), house.path("order_items")
    known = tabled.note(spark, orders_path, key)
    if known is not None and int(known) >= batch:
        return False
    with scratch(spark):
        staged = staged_once(documents, "batch")
        fit, bad = quality.split_documents(staged)
        if not bad.isEmpty():
            if quarantine is None:
                rules = sorted(row[0] for row in bad.select(F.explode("reject_reasons")).distinct().collect())  # a handful of rules
                raise ValueError(f"documents rejected in batch {batch}: {rules}")
            # a folder of its own for every batch, so that a batch that comes again writes the same
            bad.write.mode("overwrite").json(f"{quarantine}/{stream}-batch={batch}")
        orders, items = flatten.normalize_all(fit, run_at, with_order_datetime=True)
        numbers = fit.select(F.col("orderNumber").alias("order_number"))
        content = {orders_path: (schemas.ORDERS, orders), items_path: (schemas.ORDER_ITEMS, items)}
        tables.replace_keys(spark, content, numbers, ["order_number"], "order_datetime")
    tabled.note(spark, orders_path, key, str(batch))
    return True


def follow_landings(
    spark: SparkSession, house: Warehouse, folder: str, checkpoint: str, stream: str = "landing", run_at: datetime | None = None,
    files_per_batch: int | None = None, quarantine: str | None = None,
) -> StreamingQuery:
    """Bring all files that have landed since the last run into the tables, and stop.

    ``checkpoint`` is a shared folder that knows which files were read. Start it again whenever files have landed, or
    with the same checkpoint after a failure.
    """
    pin_utc(spark)
    reader = response_reader(spark.readStream)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    orders = landed_orders(reader.json(folder), monotonic=False)

    def bring(documents: DataFrame, batch: int) -> None:
        apply_batch(documents.sparkSession, house, documents.withColumn("source_line", F.monotonically_increasing_id()), batch, stream, run_at, quarantine)

    return orders.writeStream.foreachBatch(bring).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
