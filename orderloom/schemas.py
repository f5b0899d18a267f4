"""Declared schemas: five warehouse tables, the nested order document and the search page.

Column names, JSON keys and REQUIRED marks are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import tabled

TEXT, NUMBER, WHOLE, FLAG = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
DAY, INSTANT = T.DateType(), T.TimestampType()


def table(required: set[str] | None = None, **columns: T.DataType) -> T.StructType:
    """Columns in the given order; those in ``required`` must not be null."""
    return T.StructType([T.StructField(name, kind, name not in (required or ())) for name, kind in columns.items()])


ORDERS = table(
    required={"order_number", "order_datetime", "inserted_at"},
    order_number=TEXT,
    order_datetime=INSTANT,
    order_status=TEXT,
    cancel_due_date=DAY,
    total_price=NUMBER,
    goods_price=NUMBER,
    postage_price=NUMBER,
    payment_fee=NUMBER,
    used_point=NUMBER,
    payment_method=TEXT,
    card_name=TEXT,
    delivery_name=TEXT,
    delivery_date=DAY,
    rakuten_member_flag=FLAG,
    user_email=TEXT,
    prefecture=TEXT,
    city=TEXT,
    zip_code=TEXT,
    order_update_datetime=INSTANT,
    inserted_at=INSTANT,
)

ORDER_ITEMS = table(
    required={"order_number", "item_id", "inserted_at"},
    order_number=TEXT,
    basket_id=TEXT,
    item_id=TEXT,
    item_name=TEXT,
    manage_number=TEXT,
    variant_id=TEXT,
    sku_info=TEXT,
    price=NUMBER,
    price_tax_incl=NUMBER,
    quantity=WHOLE,
    subtotal=NUMBER,
    tax_rate=NUMBER,
    delivery_company=TEXT,
    inserted_at=INSTANT,
    order_datetime=INSTANT,
)

PRODUCT_MASTER = table(
    required={"manage_number"},
    manage_number=TEXT,
    product_name=TEXT,
    category_name=TEXT,
    brand_name=TEXT,
)

FIRST_PURCHASE = table(
    required={"user_email"},
    user_email=TEXT,
    first_order_number=TEXT,
    first_order_date=DAY,
    first_order_month=DAY,
    entry_manage_number=TEXT,
    entry_item_name=TEXT,
    category_name=TEXT,
    brand_name=TEXT,
    updated_at=INSTANT,
)

COHORT_LTV = table(
    entry_manage_number=TEXT,
    entry_item_name=TEXT,
    category_name=TEXT,
    brand_name=TEXT,
    first_order_month=DAY,
    month_offset=WHOLE,
    cohort_users=WHOLE,
    active_buyers=WHOLE,
    revenue_in_month=NUMBER,
    cumulative_revenue=NUMBER,
    ltv_per_user=NUMBER,
    aov_in_month=NUMBER,
    updated_at=INSTANT,
)


def _texts(*names: str, **nested: T.DataType) -> T.StructType:
    return table(**dict.fromkeys(names, TEXT), **nested)


# Scalars of the documents arrive as numbers or as text, so every leaf is read as text and cast later:
# a bad number then raises instead of turning into null inside the reader.
_SKU = _texts("variantId", "skuInfo")
_ITEM = _texts(
    "itemId", "itemName", "manageNumber", "price", "priceTaxIncl", "units", "subtotal", "taxRate",
    SkuModelList=T.ArrayType(_SKU),
)
_PACKAGE = _texts("basketId", "defaultDeliveryCompanyCode", ItemModelList=T.ArrayType(_ITEM))

ORDER_DOCUMENT = _texts(
    "orderNumber", "orderProgress", "orderDatetime", "cancelDueDate", "deliveryDate", "rakutenMemberFlag",
    "goodsPrice", "postagePrice", "totalPrice", "paymentFee", "orderUpdateDatetime",
    OrdererModel=_texts("zipCode1", "zipCode2", "prefecture", "city", "emailAddress"),
    SettlementModel=_texts("settlementMethod", "cardName"),
    DeliveryModel=_texts("deliveryName"),
    PointModel=_texts("usedPoint"),
    PackageModelList=T.ArrayType(_PACKAGE),
)

ORDER_RESPONSE = table(version=WHOLE, OrderModelList=T.ArrayType(ORDER_DOCUMENT))

SEARCH_RESPONSE = table(
    orderNumberList=T.ArrayType(TEXT),
    MessageModelList=T.ArrayType(_texts("messageType", "messageCode", "message")),
    PaginationResponseModel=table(totalRecordsAmount=WHOLE, totalPages=WHOLE, requestPage=WHOLE),
)


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Declared columns in declared order and type; absent ones become null, REQUIRED nulls raise."""
    have = set(df.columns)

    def column(field: T.StructField) -> Column:
        value = F.col(field.name) if field.name in have else F.lit(None)
        value = value.cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"required column {field.name} is null")))
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema.fields], *keep)


def with_partition(schema: T.StructType, partition: str | None) -> T.StructType:
    """The declared schema plus its derived month column, where the table has one."""
    if partition is None or partition in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(partition, T.DateType())])


def read_table(spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None) -> DataFrame:
    return tabled.read(spark, path).select(*with_partition(schema, partition).names)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None) -> bool:
    """Create an empty table unless one is there; True when it was created."""
    return tabled.create(spark, path, with_partition(schema, partition), partition)


def declare_table(spark: SparkSession, name: str, path: str) -> None:
    """A short name for a table in the session's SQL; it always shows the newest content."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}` AS SELECT * FROM {tabled.identifier(path)}")
