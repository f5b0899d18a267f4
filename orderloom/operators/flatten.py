"""Nested order documents to the flat ``orders`` and ``order_items`` columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import scalars as s


def _stamp(inserted_at: datetime | str | None) -> Column:
    """The ingest time: the job's own, so that a re-run writes the same rows, or now."""
    if inserted_at is None:
        return F.current_timestamp()
    return F.lit(str(inserted_at)).cast("timestamp")


def _required(value: Column, what: str) -> Column:
    """``value``, or an error naming the order where it is null."""
    message = F.concat(F.lit(f"{what} in order "), F.coalesce(F.col("orderNumber"), F.lit("(none)")))
    return F.coalesce(value, F.raise_error(message))


def _order_number() -> Column:
    return _required(F.col("orderNumber"), "orderNumber missing")


def normalize_orders(
    documents: DataFrame, inserted_at: datetime | str | None = None, strict: bool = True
) -> DataFrame:
    """One ``orders`` row per document.

    ``strict`` raises on an orderDatetime that is missing or unreadable; a missing orderNumber always raises.
    """
    placed = s.to_instant(F.col("orderDatetime"))
    if strict:
        placed = _required(placed, "orderDatetime missing or unreadable")
    orderer = "OrdererModel"
    return documents.select(
        _order_number().alias("order_number"),
        placed.alias("order_datetime"),
        F.col("orderProgress").alias("order_status"),
        s.to_utc_date(F.col("cancelDueDate")).alias("cancel_due_date"),
        s.to_float(F.col("totalPrice")).alias("total_price"),
        s.to_float(F.col("goodsPrice")).alias("goods_price"),
        s.to_float(F.col("postagePrice")).alias("postage_price"),
        s.to_float(F.col("paymentFee")).alias("payment_fee"),
        s.to_float(F.col("PointModel.usedPoint")).alias("used_point"),
        F.col("SettlementModel.settlementMethod").alias("payment_method"),
        F.col("SettlementModel.cardName").alias("card_name"),
        F.col("DeliveryModel.deliveryName").alias("delivery_name"),
        s.to_utc_date(F.col("deliveryDate")).alias("delivery_date"),
        s.to_flag(F.col("rakutenMemberFlag")).alias("rakuten_member_flag"),
        F.col(f"{orderer}.emailAddress").alias("user_email"),
        F.col(f"{orderer}.prefecture").alias("prefecture"),
        F.col(f"{orderer}.city").alias("city"),
        s.joined_zip(F.col(f"{orderer}.zipCode1"), F.col(f"{orderer}.zipCode2")).alias("zip_code"),
        s.to_instant(F.col("orderUpdateDatetime")).alias("order_update_datetime"),
        _stamp(inserted_at).alias("inserted_at"),
    )


def item_entries(documents: DataFrame) -> DataFrame:
    """One row per order, package and item; null, empty and absent lists give no rows."""
    packages = documents.select(
        "orderNumber", "orderDatetime", F.explode("PackageModelList").alias("package")
    )
    return packages.select(
        "orderNumber",
        "orderDatetime",
        F.col("package.basketId").alias("basketId"),
        F.col("package.defaultDeliveryCompanyCode").alias("courier"),
        F.explode("package.ItemModelList").alias("item"),
    )


def normalize_order_items(
    documents: DataFrame,
    inserted_at: datetime | str | None = None,
    strict: bool = True,
    with_order_datetime: bool = False,
) -> DataFrame:
    """One ``order_items`` row per item. ``strict`` raises on an item without itemId.

    ``with_order_datetime`` copies the order's time from the same document, which needs no join.
    """
    item_id = F.col("item.itemId")
    if strict:
        item_id = _required(item_id, "itemId missing")
    first_sku = F.get("item.SkuModelList", F.lit(0))
    price, units = F.col("item.priceTaxIncl"), F.col("item.units")
    columns = [
        _order_number().alias("order_number"),
        F.col("basketId").alias("basket_id"),
        item_id.alias("item_id"),
        F.col("item.itemName").alias("item_name"),
        F.col("item.manageNumber").alias("manage_number"),
        first_sku["variantId"].alias("variant_id"),
        first_sku["skuInfo"].alias("sku_info"),
        s.to_float(F.col("item.price")).alias("price"),
        s.to_float(price).alias("price_tax_incl"),
        s.to_whole(units).alias("quantity"),
        F.coalesce(s.to_float(F.col("item.subtotal")), s.line_total(price, units)).alias("subtotal"),
        s.to_float(F.col("item.taxRate")).alias("tax_rate"),
        F.col("courier").alias("delivery_company"),
        _stamp(inserted_at).alias("inserted_at"),
    ]
    if with_order_datetime:
        columns.append(s.to_instant(F.col("orderDatetime")).alias("order_datetime"))
    return item_entries(documents).select(*columns)


def normalize_all(
    documents: DataFrame, inserted_at: datetime | str | None = None, with_order_datetime: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Both frames with one ingest time."""
    items = normalize_order_items(documents, inserted_at, with_order_datetime=with_order_datetime)
    return normalize_orders(documents, inserted_at), items


def attach_order_datetime(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with their order's time looked up by order number; no such order gives null.

    A repeated order number counts once, with its earliest time. The lookup side is reduced before the
    shuffle and holds one row per order; AQE may split a hot order on the item side.
    """
    times = orders.groupBy("order_number").agg(F.min("order_datetime").alias("order_datetime"))
    return items.drop("order_datetime").join(times, "order_number", "left")
