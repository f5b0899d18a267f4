"""The given star-schema tables read as shop data: orders, items, master, and nested documents.

Documents are built one per order header and one per order line. A line document carries the order's
number with its package, so no order is ever gathered into one row, however many lines it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.calendar import iso_local
from orderloom.operators.flatten import attach_order_datetime
from orderloom.schemas import NUMBER, ORDER_DOCUMENT, TEXT, WHOLE, table

# These products are left out of the master, so that sold products without one exist.
UNMASTERED = ("Brand#24", "Brand#25")


_AT, _INT = T.TimestampNTZType(), T.IntegerType()

# The columns of the given tables, declared so that no job runs just to infer them
GIVEN = {
    "orders": table(
        o_orderkey=WHOLE, o_custkey=WHOLE, o_orderstatus=TEXT, o_totalprice=NUMBER, o_orderdate=_AT,
        o_orderpriority=TEXT,
    ),
    "lineitem": table(
        l_orderkey=WHOLE, l_partkey=WHOLE, l_suppkey=WHOLE, l_linenumber=_INT, l_quantity=NUMBER,
        l_extendedprice=NUMBER, l_discount=NUMBER, l_tax=NUMBER, l_returnflag=TEXT, l_linestatus=TEXT,
        l_shipdate=_AT,
    ),
    "part": table(
        p_partkey=WHOLE, p_name=TEXT, p_brand=TEXT, p_type=TEXT, p_size=_INT, p_retailprice=NUMBER,
    ),
    "events": table(
        event_id=WHOLE, ts=_AT, user_id=WHOLE, event_type=TEXT, value=NUMBER, props=TEXT,
    ),
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utc(column: str) -> Column:
    """The tables store wall-clock times without zone; they are UTC."""
    return F.col(column).cast("timestamp")


def _status() -> Column:
    return F.when(F.col("o_orderstatus") == "P", "900").when(F.col("o_orderstatus") == "O", "300").otherwise("700")


def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_number"),
        F.col("o_custkey").cast("string").alias("user_email"),
        utc("o_orderdate").alias("order_datetime"),
        _status().alias("order_status"),
        F.col("o_totalprice").alias("total_price"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their product; Spark picks the join by the size of ``part``."""
    return given(spark, sf_dir, "lineitem").join(
        given(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )


def shop_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(F.col("l_orderkey").cast("string").alias("order_number"), *_named(item_columns()))


def timed_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Order lines with the times of their orders and what items show of their product. The lines meet the orders before they get the
    texts of their product, so that what is shuffled for it is narrow."""
    lines = given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_number"), "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("l_quantity")
    )
    timed = attach_order_datetime(lines, orders).join(given(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return timed.select("order_number", "l_partkey", "l_suppkey", "l_quantity", "p_brand", "p_name", "p_retailprice", "order_datetime")


def timed_items(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """``shop_items`` with the times of their orders."""
    return timed_lines(spark, sf_dir, orders).select("order_number", *_named(item_columns()), "order_datetime")


def item_columns() -> dict[str, Column]:
    """What an item says of its line and product."""
    quantity = F.col("l_quantity").cast("bigint")
    subtotal = F.col("p_retailprice").cast("decimal(12,2)") * quantity.cast("decimal(12,0)")
    return {
        "basket_id": F.col("l_suppkey").cast("string"),
        "manage_number": F.col("p_brand"),
        "item_name": F.col("p_name"),
        "variant_id": F.col("l_partkey").cast("string"),
        "quantity": quantity,
        "price_tax_incl": F.col("p_retailprice"),
        "subtotal": subtotal.cast("double"),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in columns.items()]


def shop_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part").where(~F.col("p_brand").isin(*UNMASTERED))
    return part.select(
        F.col("p_brand").alias("manage_number"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_name"),
        F.col("p_size").cast("string").alias("brand_name"),
    )


def _as_documents(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Rows with all document fields; those not given are null."""
    return rows.select(
        *[columns.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in ORDER_DOCUMENT.fields]
    )


def _struct(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def header_documents(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """One document per order with its header. ``broken`` spoils the keys of some, for the checks."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    low = F.col("o_orderpriority") == "5-LOW"
    vague = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    number, placed = F.col("o_orderkey").cast("string"), iso_local(utc("o_orderdate"))
    if broken:
        number = F.when(~urgent, number)
        placed = F.when(low, F.lit("")).when(vague, F.lit("soon")).otherwise(placed)
    columns = {
        "orderNumber": number,
        "orderProgress": _status(),
        "orderDatetime": placed,
        "cancelDueDate": F.concat(day, F.lit("T03:00:00+0900")),
        "deliveryDate": F.when(low, F.lit("")).otherwise(day),
        "rakutenMemberFlag": F.when(urgent, F.lit("1")).when(~low, F.lit("0")),
        "goodsPrice": F.col("o_totalprice").cast("string"),
        "postagePrice": F.when(vague, F.lit("")).otherwise(F.lit("500")),
        "totalPrice": F.col("o_totalprice").cast("string"),
        "paymentFee": F.when(urgent, F.lit("330")),
        "orderUpdateDatetime": F.when(low, day),
        "OrdererModel": _struct(
            zipCode1=F.col("o_orderstatus"),
            zipCode2=F.when(low, F.lit("")).otherwise(F.lit("0094")),
            prefecture=F.col("o_orderstatus"),
            city=F.col("o_orderpriority"),
            emailAddress=F.col("o_custkey").cast("string"),
        ),
        "SettlementModel": F.when(
            ~urgent, _struct(settlementMethod=F.col("o_orderpriority"), cardName=F.lit("CARD"))
        ),
        "DeliveryModel": _struct(deliveryName=F.col("o_orderpriority")),
        "PointModel": F.when(~vague, _struct(usedPoint=F.col("o_custkey").cast("string"))),
    }
    return _as_documents(given(spark, sf_dir, "orders"), columns)


def line_documents(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """One document per order line, with a number of its own: a package without an item list, one with the item and two
    SKUs, and one with that item and another that has next to nothing."""
    item_id = F.col("l_partkey").cast("string")
    returned = F.col("l_returnflag") == "R"
    if broken:
        item_id = F.when(~returned, item_id)
    price = F.col("p_retailprice").cast("string")
    skus = F.array(
        *[_struct(variantId=variant, skuInfo=F.col("l_linestatus")) for variant in (F.col("l_partkey").cast("string"), F.lit("second"))]
    )
    item = _struct(
        itemId=item_id,
        itemName=F.col("p_name"),
        manageNumber=F.col("p_brand"),
        price=price,
        priceTaxIncl=F.when(F.col("l_returnflag") != "N", price),
        units=F.col("l_quantity").cast("bigint").cast("string"),
        subtotal=F.when(returned, F.col("l_extendedprice").cast("string")),
        taxRate=F.when(returned, F.lit("")).otherwise(F.col("l_tax").cast("string")),
        SkuModelList=F.when(F.col("l_linestatus") == "F", skus),
    )

    def package(items: Column) -> Column:
        return _struct(
            basketId=F.col("l_suppkey").cast("string"),
            defaultDeliveryCompanyCode=F.col("l_linestatus"),
            ItemModelList=items,
        )

    nothing = F.lit(None).cast("string")
    bare = _struct(
        itemId=F.concat(F.lit("x"), "l_partkey"), itemName=F.lit("bare"), manageNumber=nothing, price=nothing, priceTaxIncl=nothing,
        units=nothing, subtotal=nothing, taxRate=nothing, SkuModelList=F.when(F.lit(False), skus),
    )
    one_item = F.array(item)
    no_list = F.when(F.lit(False), one_item)
    columns = {
        "orderNumber": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")),
        "orderDatetime": iso_local(utc("l_shipdate")),
        "PackageModelList": F.array(package(no_list), package(one_item), package(F.array(item, bare))),
    }
    return _as_documents(_lines(spark, sf_dir), columns)


def master_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master as it is typed: spaces around the texts, marks for missing values, repeated rows."""
    size, kind = F.col("p_size"), F.col("p_type")
    return given(spark, sf_dir, "part").select(
        F.when(size == 1, F.lit("　 ")).otherwise(F.concat(F.lit("　"), F.col("p_brand"), F.lit(" "))).alias("商品管理番号"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("　")).alias("商品名"),
        F.when(kind == "PROMO", F.lit("N/A")).otherwise(kind).alias("カテゴリ名"),
    )


def master_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet grids of a header and one row each; rows are shorter or longer than the header."""
    part = given(spark, sf_dir, "part")
    header = F.array(*[F.lit(h) for h in ("ブランド名", "商品管理番号", "商品名", "カテゴリ名")])
    cells = [F.col("p_size").cast("string"), F.col("p_brand"), F.col("p_name"), F.col("p_type"), F.lit("note")]
    length = F.when(F.col("p_size") < 10, 2).when(F.col("p_size") < 20, 3).otherwise(5)
    return part.select(F.array(header, F.slice(F.array(*cells), F.lit(1), length)).alias("values"))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search page per order line, so an order number is listed as often as it has lines, in the week it was shipped.

    Pages of returned lines hold a null list, and each page lists its number twice.
    """
    number = F.col("l_orderkey").cast("string")
    return given(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.array(number, number)).alias("orderNumberList"),
        F.struct(F.col("l_linenumber").cast("bigint").alias("requestPage")).alias("PaginationResponseModel"),
        F.trunc(F.to_date("l_shipdate"), "week").alias("chunk"),
    )
