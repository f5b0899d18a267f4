"""Landed order documents and search pages, and the sink that lands them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.calendar import DETAIL_BATCH
from orderloom.operators.numbering import numbered, numbered_as_they_lie
from orderloom.schemas import ORDER_DOCUMENT, ORDER_RESPONSE, SEARCH_RESPONSE
from orderloom.session import drop_stage, stage, unsent

RESPONSE_VERSION = 9
FILE_ORDERS = 100_000  # the most orders of one landed file, which is one task's work to read
FEW_FILES = 10_000  # parameter: the most files that are looked up with each reading of their documents, instead of staging what is left of these


def _options(reader, multi_line: bool = False):
    # FAILFAST: a document that is no JSON, or a list that is none, stops the read. Folders are read as they are nested
    return reader.option("mode", "FAILFAST").option("multiLine", multi_line).option("recursiveFileLookup", True)


def _json(spark: SparkSession, schema, paths: str | list[str], multi_line: bool) -> DataFrame:
    return _options(spark.read.schema(schema), multi_line).json(paths)


def response_reader(reader):
    """A reader, of a folder or of a stream, for response objects, one per line."""
    return _options(reader.schema(ORDER_RESPONSE))


def _sources(monotonic: bool = True) -> list:
    """Where a row came from: its landing, the file, the block and the line (which a stream has to number later).

    A landing is named by its folder, never by the time of a file: the files of one landing are written one after the other,
    and a copied folder has new times. Its rank is the ingest time of the folder, or its year and month, as
    digits from the year to the second; 0 where the folder says neither.
    """
    path = F.col("_metadata.file_path")

    def digits(pattern: str) -> Column:
        return F.regexp_extract(path, pattern, 1)

    month = F.concat(digits(r"year=(\d{4})(?:/|$)"), F.lpad(digits(r"month=(\d{1,2})/"), 2, "0"))
    landed = F.coalesce(F.nullif(digits(r"landing=(\d{14})/"), F.lit("")), F.when(F.length(month) == 6, F.rpad(month, 14, "0")), F.lit("0"))
    return [
        landed.cast("bigint").alias("source_landed"),
        path.alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        (F.monotonically_increasing_id() if monotonic else F.lit(None).cast("bigint")).alias("source_line"),
    ]


SOURCE = ["source_landed", "source_file", "source_block", "source_line", "source_position"]


def read_order_documents(
    spark: SparkSession, paths: str | list[str], multi_line: bool = False
) -> DataFrame:
    """One row per order from response objects ``{"OrderModelList": [...], "version": n}``.

    ``multi_line`` reads one pretty-printed object per file; without it there is one object per line
    and a large file is split over many tasks. The ``source_`` columns say where an order came from.
    """
    return landed_orders(_json(spark, ORDER_RESPONSE, paths, multi_line))


def landed_orders(responses: DataFrame, monotonic: bool = True) -> DataFrame:
    """One row per order of the responses, with its source."""
    listed = responses.select("OrderModelList", *_sources(monotonic))
    orders = listed.select(*SOURCE[:-1], F.posexplode("OrderModelList").alias("source_position", "doc"))
    return orders.select("doc.*", *SOURCE)


def read_order_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per order from newline-delimited JSON that holds one bare order on each line."""
    rows = _json(spark, ORDER_DOCUMENT, paths, False)
    return rows.select(*ORDER_DOCUMENT.names, *_sources(), F.lit(0).alias("source_position"))


def first_documents(documents: DataFrame) -> DataFrame:
    """One document per order number: of the newest landing, and in it the first by file, line and position.

    ``documents`` are best staged: they are read for the numbers that come up again, and once more without the copies.
    Documents without an order number are all kept for the quality checks to find. The first place of a number is a minimum that is
    folded before the shuffle, so a number that holds a third of all documents is no task of its own. Without copies ``documents`` are
    returned as they are. A file all of whose documents came again later, or none, needs no join; only documents of other files meet
    the first places of their numbers.
    """
    return _first_documents(documents)[0]


def _first_documents(documents: DataFrame) -> tuple[DataFrame, bool]:
    """``first_documents``, and whether they cost so little to find again in ``documents`` that they need not be staged: whole files are
    looked up in a list of a few. Documents that landed before all such files are passed over by the statistics of staged ones."""
    spark = documents.sparkSession
    place = F.struct((-F.col("source_landed")).alias("landed"), *SOURCE[1:])
    found = documents.where("orderNumber IS NOT NULL")
    firsts = found.select("orderNumber", place.alias("place")).groupBy("orderNumber").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = stage(spark, firsts, "first-places", codec="zstd")
    again = firsts.where("copies > 1").select("orderNumber", "first")
    repeated = again.count()
    if not repeated:
        return documents, True
    firsts_in = firsts.groupBy(F.col("first.source_file").alias("source_file")).agg(F.count(F.lit(1)).alias("firsts"))
    files = found.groupBy("source_file").agg(F.count(F.lit(1)).alias("numbered"), F.min("source_landed").alias("landed"))
    files = files.join(firsts_in, "source_file", "left").select("source_file", "numbered", "landed", F.coalesce("firsts", F.lit(0)).alias("firsts"))
    # a row per file, which is small enough to be broadcast once Spark knows its size
    files = stage(spark, files, "files-with-firsts")
    few = files.count() <= FEW_FILES
    files_known = F.broadcast(files) if few else files
    oldest = files.where("firsts = numbered").agg(F.min("landed")).first()[0]
    recent = documents if oldest is None else documents.where(f"orderNumber IS NULL OR source_landed IS NULL OR source_landed >= {oldest}")
    whole = recent.join(files_known, "source_file", "left").where("firsts = numbered OR orderNumber IS NULL").select(*documents.columns)
    if files.where("firsts > 0 AND firsts < numbered OR source_file IS NULL").isEmpty():
        return whole, few
    marked = documents.join(files_known, "source_file", "left")
    mixed = marked.where("orderNumber IS NOT NULL AND (numbered IS NULL OR firsts > 0 AND firsts < numbered)").select(*documents.columns)
    kept = mixed.join(unsent(again, repeated), "orderNumber", "left")
    kept = kept.where(F.col("first").isNull() | place.eqNullSafe(F.col("first")))
    return whole.unionByName(kept.select(*documents.columns)), False


def staged_once(documents: DataFrame, label: str) -> DataFrame:
    """``first_documents`` of documents in the shared folder, so that they are parsed once and copies are looked for once."""
    spark = documents.sparkSession
    every = stage(spark, documents, label, codec="zstd")
    kept, found_again = _first_documents(every)
    if found_again:
        return kept
    kept = stage(spark, kept, label, codec="zstd")
    drop_stage(every)
    return kept


def write_order_documents(documents: DataFrame, path: str, ingested_at: datetime, batch: int = 1) -> None:
    """Append orders below ``path``, one response object per line, in folders by ingest year, month and time (UTC).

    A response holds ``batch`` orders. Orders are numbered without gaps before they are gathered, so that no response grows
    beyond that, however the orders are dealt out. Files are compressed, which leaves a fifteenth of the text; since gzip does not
    split over tasks, a file holds ``FILE_ORDERS`` orders at most.
    """
    present = [name for name in ORDER_DOCUMENT.names if name in documents.columns]
    order = F.struct(*present)
    if batch > 1:
        placed = numbered_as_they_lie(documents.select(order.alias("order")), "numbered-documents")
        groups = placed.groupBy(F.floor(F.col("position") / batch).alias("batch"))
        lists = groups.agg(F.collect_list("order").alias("OrderModelList")).select("OrderModelList")
    else:
        lists = documents.select(F.array(order).alias("OrderModelList"))
    response = lists.select(
        "OrderModelList",
        F.lit(RESPONSE_VERSION).alias("version"),
        F.lit(f"{ingested_at:%Y}").alias("year"),
        F.lit(f"{ingested_at:%m}").alias("month"),
        F.lit(f"{ingested_at:%Y%m%d%H%M%S}").alias("landing"),
    )
    writer = response.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", max(FILE_ORDERS // batch, 1))
    writer.partitionBy("year", "month", "landing").json(path)


def write_text(lines: DataFrame, path: str) -> None:
    """Append a single text column below ``path``."""
    lines.write.mode("append").text(path)


def read_search_pages(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    """Search pages with ``chunk``, the day that the chunk of time they belong to begins with; it is the folder's
    (``chunk=2024-07-01``), and null where the folder does not say."""
    pages = _json(spark, SEARCH_RESPONSE, paths, multi_line)
    day = F.regexp_extract(F.col("_metadata.file_path"), r"chunk=(\d{4}-\d{2}-\d{2})/", 1)
    return pages.select(*SEARCH_RESPONSE.names, F.nullif(day, F.lit("")).cast("date").alias("chunk"))


def found_order_numbers(pages: DataFrame) -> DataFrame:
    """Each order number once, with the place that listed it first: chunk, page and place on the page.

    Pages count from 1 in every chunk, so a page alone says nothing of the order. A page with a null list adds nothing.
    """
    listed = pages.select("chunk", F.col("PaginationResponseModel.requestPage").alias("page"), F.posexplode("orderNumberList").alias("place", "order_number"))
    first = listed.groupBy("order_number").agg(F.min(F.struct("chunk", "page", "place")).alias("first"))
    return first.select(
        "order_number", F.col("first.chunk").alias("first_chunk"), F.col("first.page").alias("first_page"), F.col("first.place").cast("bigint").alias("first_place")
    )


def detail_batches(found: DataFrame, size: int = DETAIL_BATCH) -> DataFrame:
    """The numbers of ``found_order_numbers`` in the order of their listing: ``position`` from 0, and the ``batch`` of
    ``size`` numbers that one detail call fetches. Numbers listed in one place stand by themselves."""
    order = [F.col(c).asc_nulls_first() for c in ("first_chunk", "first_page", "first_place", "order_number")]
    return numbered(found, order, "found-in-order").select("order_number", "position", F.floor(F.col("position") / size).alias("batch"))
