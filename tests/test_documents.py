import json
import os
from datetime import date, datetime

import pytest

from orderloom.operators import flatten, quality
from orderloom.schemas import ORDER_DOCUMENT, ORDER_ITEMS, ORDERS
from orderloom.session import stage
from orderloom.sources import documents

# A response as the shop's interface documents it
SAMPLE = {
    "version": 9,
    "MessageModelList": [{"messageType": "INFO", "messageCode": "X", "message": "ok"}],
    "OrderModelList": [
        {
            "orderNumber": "n-1", "orderProgress": 100, "subStatusId": None,
            "orderDatetime": "2024-06-24T13:40:33+0900", "cancelDueDate": "2024-07-08", "deliveryDate": "2024-06-25",
            "rakutenMemberFlag": 1, "goodsPrice": 1500, "postagePrice": 500, "paymentCharge": 0, "totalPrice": 2150,
            "OrdererModel": {"zipCode1": "158", "zipCode2": "0094", "prefecture": "東京都", "city": "世田谷区", "emailAddress": "u@x"},
            "SettlementModel": {"settlementMethod": "クレジットカード", "cardName": "MASTER"},
            "DeliveryModel": {"deliveryName": "宅配便", "deliveryClass": None},
            "PointModel": {"usedPoint": 2150},
            "WrappingModel1": None,
            "PackageModelList": [
                {
                    "basketId": 2668396, "defaultDeliveryCompanyCode": "1001",
                    "ItemModelList": [
                        {
                            "itemId": 10000060, "itemName": "サンプル商品１", "manageNumber": "22080313", "price": 1500,
                            "units": 1, "taxRate": 0.1, "priceTaxIncl": 1650,
                            "SkuModelList": [{"variantId": "22080313", "skuInfo": None}],
                        }
                    ],
                }
            ],
        }
    ],
}


def land(tmp_path, *responses, indent=None):
    folder = tmp_path / "raw"
    folder.mkdir(exist_ok=True)
    for i, response in enumerate(responses):
        (folder / f"{i}.json").write_text(json.dumps(response, ensure_ascii=False, indent=indent), encoding="utf-8")
    return str(folder)


def read(spark, tmp_path, *orders):
    return documents.read_order_documents(spark, land(tmp_path, {"OrderModelList": list(orders), "version": 9}))


def test_sample_order_and_item(spark, tmp_path):
    docs = documents.read_order_documents(spark, land(tmp_path, SAMPLE, indent=2), multi_line=True)
    orders, items = flatten.normalize_all(docs, datetime(2024, 7, 1))
    assert orders.columns == ORDERS.names and items.columns == ORDER_ITEMS.names[:-1]
    o = orders.first()
    assert (o.order_number, o.order_status, o.total_price, o.used_point) == ("n-1", "100", 2150.0, 2150.0)
    assert (o.goods_price, o.postage_price, o.payment_fee, o.order_update_datetime) == (1500.0, 500.0, None, None)
    assert (o.zip_code, o.rakuten_member_flag, o.user_email) == ("158-0094", True, "u@x")
    assert (o.order_datetime, o.cancel_due_date, o.delivery_date) == (
        datetime(2024, 6, 24, 4, 40, 33), date(2024, 7, 8), date(2024, 6, 25),
    )
    assert (o.payment_method, o.card_name, o.delivery_name) == ("クレジットカード", "MASTER", "宅配便")
    i = items.first()
    assert (i.order_number, i.basket_id, i.item_id, i.manage_number) == ("n-1", "2668396", "10000060", "22080313")
    assert (i.quantity, i.price, i.price_tax_incl, i.subtotal, i.tax_rate) == (1, 1500.0, 1650.0, 1650.0, 0.1)
    assert (i.variant_id, i.sku_info, i.delivery_company) == ("22080313", None, "1001")


AT = "2024-06-24T13:40:33+0900"


def test_missing_and_null_parts(spark, tmp_path):
    docs = read(
        spark, tmp_path,
        {"orderNumber": "bare", "orderDatetime": AT},
        {"orderNumber": "nulls", "orderDatetime": AT, "OrdererModel": None, "SettlementModel": None, "DeliveryModel": None,
         "PointModel": None, "PackageModelList": None, "orderProgress": None, "rakutenMemberFlag": None},
        {"orderNumber": "empty", "orderDatetime": AT, "totalPrice": "", "PackageModelList": [], "rakutenMemberFlag": 0},
        {"orderNumber": "inner", "orderDatetime": AT, "totalPrice": "12.5",
         "PackageModelList": [{"basketId": 1}, {"basketId": 2, "ItemModelList": None}, {"ItemModelList": []}]},
    )
    rows = {r.order_number: r for r in flatten.normalize_orders(docs).collect()}
    assert set(rows) == {"bare", "nulls", "empty", "inner"}
    for name in ("bare", "nulls"):
        assert all(rows[name][c] is None for c in ("user_email", "order_status", "used_point", "rakuten_member_flag", "total_price"))
    assert rows["empty"].total_price is None and rows["empty"].rakuten_member_flag is False
    assert rows["inner"].total_price == 12.5
    assert flatten.normalize_order_items(docs).count() == 0


def test_items_of_many_packages(spark, tmp_path):
    docs = read(
        spark, tmp_path,
        {"orderNumber": "a", "orderDatetime": AT, "PackageModelList": [
            {"basketId": 1, "ItemModelList": [
                {"itemId": 1, "units": 3, "priceTaxIncl": 110, "SkuModelList": [{"variantId": "v1", "skuInfo": "red"}, {"variantId": "v2"}]},
                {"itemId": 2, "units": None, "priceTaxIncl": 110, "SkuModelList": []},
                {"itemId": 3, "units": 2, "priceTaxIncl": 110, "subtotal": 99, "SkuModelList": None}]},
            {"ItemModelList": [{"itemId": 4, "units": "", "subtotal": ""}]}]},
    )
    rows = {r.item_id: r for r in flatten.normalize_order_items(docs, with_order_datetime=True).collect()}
    assert (rows["1"].subtotal, rows["1"].variant_id, rows["1"].sku_info, rows["1"].basket_id) == (330.0, "v1", "red", "1")
    assert (rows["2"].subtotal, rows["2"].quantity, rows["2"].variant_id) == (None, None, None)
    assert rows["3"].subtotal == 99.0
    assert (rows["4"].basket_id, rows["4"].subtotal, rows["4"].quantity) == (None, None, None)
    assert all(r.order_datetime == datetime(2024, 6, 24, 4, 40, 33) for r in rows.values())


@pytest.mark.parametrize("bad, message", [
    ({"orderDatetime": AT}, "orderNumber missing"),
    ({"orderNumber": "x"}, "orderDatetime missing or unreadable in order x"),
    ({"orderNumber": "x", "orderDatetime": "soon"}, "orderDatetime missing or unreadable in order x"),
    ({"orderNumber": "x", "orderDatetime": AT, "totalPrice": "much"}, "CAST_INVALID_INPUT"),
])
def test_bad_orders_raise(spark, tmp_path, bad, message):
    with pytest.raises(Exception, match=message):
        flatten.normalize_orders(read(spark, tmp_path, bad)).collect()


def test_lax_mode_keeps_the_key_check(spark, tmp_path):
    docs = read(spark, tmp_path, {"orderNumber": "x", "PackageModelList": [{"ItemModelList": [{"itemName": "i"}]}]})
    assert flatten.normalize_orders(docs, strict=False).first().order_datetime is None
    assert flatten.normalize_order_items(docs, strict=False).first().item_id is None
    with pytest.raises(Exception, match="itemId missing in order x"):
        flatten.normalize_order_items(docs).collect()
    with pytest.raises(Exception, match="orderNumber missing"):
        flatten.normalize_orders(read(spark, tmp_path, {"orderDatetime": AT}), strict=False).collect()


def test_a_list_that_is_none_raises(spark, tmp_path):
    docs = documents.read_order_documents(spark, land(tmp_path, {"OrderModelList": "none", "version": 9}))
    with pytest.raises(Exception):
        docs.collect()


def test_checks(spark, tmp_path):
    item = {"itemId": 1}
    docs = read(
        spark, tmp_path,
        {"orderNumber": "good", "orderDatetime": AT, "PackageModelList": [{"ItemModelList": [item, item]}]},
        {"orderDatetime": "", "PackageModelList": None},
        {"orderNumber": "late", "orderDatetime": "soon", "PackageModelList": [{"ItemModelList": None}, {"ItemModelList": [item, {}]}]},
    )
    report = {r.rule: (r.checked, r.rejected) for r in quality.reject_report(docs).collect()}
    assert report == {
        "order_number_missing": (3, 1), "order_datetime_missing": (3, 1),
        "order_datetime_unreadable": (3, 1), "item_id_missing": (4, 1),
    }
    fit, bad = quality.split_documents(docs)
    assert [r.orderNumber for r in fit.collect()] == ["good"]
    assert {r.orderNumber: set(r.reject_reasons) for r in bad.collect()} == {
        None: {"order_number_missing", "order_datetime_missing"},
        "late": {"order_datetime_unreadable", "item_id_missing"},
    }


def test_one_file_and_many_files_are_equal(spark, tmp_path):
    orders = [{"orderNumber": str(i), "orderDatetime": AT, "totalPrice": i} for i in range(5)]
    one, many = tmp_path / "one", tmp_path / "many"
    one.mkdir(), many.mkdir()
    a = land(one, {"OrderModelList": orders, "version": 9})
    b = land(many, *[{"OrderModelList": [o], "version": 9} for o in orders])
    rows = [sorted(map(tuple, flatten.normalize_orders(documents.read_order_documents(spark, p), "2024-01-01").collect())) for p in (a, b)]
    assert rows[0] == rows[1] and len(rows[0]) == 5


def test_repeated_orders_keep_the_first(spark, tmp_path):
    docs = documents.read_order_documents(spark, land(
        tmp_path,
        {"OrderModelList": [{"orderNumber": "a", "totalPrice": 1}, {"orderNumber": "a", "totalPrice": 2}], "version": 9},
        {"OrderModelList": [{"orderNumber": "a", "totalPrice": 3}, {"orderNumber": "b"}, {"totalPrice": 4}, {"totalPrice": 4}], "version": 9},
    ))
    kept = documents.first_documents(docs).collect()
    assert sorted((r.orderNumber or "", r.totalPrice or "") for r in kept) == [("", "4"), ("", "4"), ("a", "1"), ("b", "")]


def test_round_trip_of_landed_documents(spark, tmp_path):
    docs = documents.read_order_documents(spark, land(tmp_path, SAMPLE, indent=2), multi_line=True)
    path = str(tmp_path / "landed")
    documents.write_order_documents(docs, path, datetime(2024, 7, 3))
    documents.write_order_documents(docs, path, datetime(2024, 8, 3))
    assert (tmp_path / "landed" / "year=2024" / "month=07" / "landing=20240703000000").is_dir()
    again = documents.read_order_documents(spark, path)
    want = docs.select(*ORDER_DOCUMENT.names).first()
    assert [r for r in again.select(*ORDER_DOCUMENT.names).collect()] == [want, want]


def test_bare_order_lines(spark, tmp_path):
    file = tmp_path / "orders.ndjson"
    file.write_text("\n".join(json.dumps({"orderNumber": n, "orderDatetime": AT}) for n in "abc"))
    assert documents.read_order_lines(spark, str(file)).count() == 3


def test_search_pages(spark, tmp_path):
    pages = [
        {"orderNumberList": ["a", "b"], "PaginationResponseModel": {"totalRecordsAmount": 4, "totalPages": 2, "requestPage": 1}},
        {"orderNumberList": ["b", "c"], "PaginationResponseModel": {"totalRecordsAmount": 4, "totalPages": 2, "requestPage": 2}},
        {"orderNumberList": [], "PaginationResponseModel": {"totalRecordsAmount": None, "totalPages": None, "requestPage": None}},
        {"orderNumberList": None, "MessageModelList": [{"messageType": "ERROR"}], "PaginationResponseModel": None},
    ]
    found = documents.found_order_numbers(documents.read_search_pages(spark, land(tmp_path, *pages, indent=2), multi_line=True))
    assert sorted(map(tuple, found.collect())) == [("a", None, 1, 0), ("b", None, 1, 1), ("c", None, 2, 1)]


def test_listings_over_weekly_chunks_and_batches(spark, tmp_path):
    """Pages count from 1 in every chunk: the later chunk's first page comes after the earlier one's second."""
    for day, lists in (("2024-07-08", [["x", "c"], ["d"]]), ("2024-07-01", [["a", "b"], ["c", "a"]])):
        folder = tmp_path / f"chunk={day}"
        folder.mkdir()
        land(folder, *[{"orderNumberList": numbers, "PaginationResponseModel": {"requestPage": k + 1}} for k, numbers in enumerate(lists)])
    found = documents.found_order_numbers(documents.read_search_pages(spark, str(tmp_path)))
    batches = documents.detail_batches(found, 2)
    assert sorted(map(tuple, batches.collect()), key=lambda r: r[1]) == [("a", 0, 0), ("b", 1, 0), ("c", 2, 1), ("x", 3, 1), ("d", 4, 2)]


def test_documents_of_a_hundred_orders(spark, tmp_path):
    orders = spark.range(1005).selectExpr("if(id < 700, 'hot', cast(id as string)) as orderNumber", "cast(id as string) as totalPrice")
    path = str(tmp_path / "raw")
    documents.write_order_documents(orders, path, datetime(2024, 7, 3), batch=100)
    lines = [json.loads(r.value)["OrderModelList"] for r in spark.read.text(path).collect()]
    assert sorted(map(len, lines)) == [5] + [100] * 10
    again = documents.read_order_documents(spark, path)
    assert sorted((r.orderNumber, r.totalPrice) for r in again.collect()) == sorted((r.orderNumber, r.totalPrice) for r in orders.collect())


def test_landed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    """gzip does not split, so no file may hold more than one task should read."""
    monkeypatch.setattr(documents, "FILE_ORDERS", 200)
    orders = spark.range(1005).coalesce(1).selectExpr("cast(id as string) as orderNumber", "cast(id as string) as totalPrice")
    for batch in (1, 100):
        path = tmp_path / f"raw-{batch}"
        documents.write_order_documents(orders, str(path), datetime(2024, 7, 3), batch=batch)
        files = [f for f in path.rglob("part-*")]
        assert all(f.name.endswith(".json.gz") for f in files)
        held = [spark.read.json(str(f)).selectExpr("sum(size(OrderModelList))").first()[0] for f in files]
        assert sum(held) == 1005 and max(held) <= 200
        assert documents.read_order_documents(spark, str(path)).select("orderNumber").distinct().count() == 1005


def test_documents_without_copies_are_not_joined(spark, tmp_path):
    path = str(tmp_path / "raw")
    numbers = spark.createDataFrame([("1",), ("2",), (None,), (None,)], "orderNumber string")
    documents.write_order_documents(numbers, path, datetime(2024, 7, 3))
    staged = stage(spark, documents.read_order_documents(spark, path), "docs")
    kept = documents.first_documents(staged)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(str(r.orderNumber) for r in kept.collect()) == ["1", "2", "None", "None"]


@pytest.mark.parametrize("newer", [range(6), range(3), range(4, 9)])
def test_files_that_came_again_as_a_whole_are_not_shuffled(spark, tmp_path, newer):
    """An older landing goes as a whole, in part, or has numbers of its own; documents without a number all stay."""
    path = str(tmp_path / "raw")
    for numbers, day, price in ((range(6), 3, "old"), (newer, 9, "new")):
        rows = spark.createDataFrame([(str(n), price) for n in numbers] + [(None, price)], "orderNumber string, totalPrice string").coalesce(1)
        documents.write_order_documents(rows, path, datetime(2024, 7, day))
    staged = stage(spark, documents.read_order_documents(spark, path), "docs")
    kept = documents.first_documents(staged)
    wanted = {str(n): "old" for n in range(6)} | {str(n): "new" for n in newer}
    assert sorted((r.orderNumber, r.totalPrice) for r in kept.collect() if r.orderNumber) == sorted(wanted.items())
    assert sorted(r.totalPrice for r in kept.collect() if not r.orderNumber) == ["new", "old"]
    if list(newer) == list(range(6)):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_text_sink(spark, tmp_path):
    lines = spark.createDataFrame([("one",), ("two",)], "value string")
    documents.write_text(lines, str(tmp_path / "logs"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "logs")).collect()) == ["one", "two"]


def test_missing_orders(spark):
    searched = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "order_number string")
    fetched = spark.createDataFrame([("a",), ("a",)], "order_number string")
    assert sorted(r.order_number for r in quality.missing_orders(searched, fetched).collect()) == ["b", "c"]


def test_the_newest_landing_counts_and_in_it_the_first_line(spark, tmp_path):
    old = [{"orderNumber": str(n), "orderProgress": "300"} for n in range(20)]
    documents.write_order_documents(spark.createDataFrame([(r["orderNumber"], r["orderProgress"]) for r in old], "orderNumber string, orderProgress string"), str(tmp_path / "raw"), datetime(2024, 7, 3))
    folder = tmp_path / "raw" / "year=2024" / "month=08"
    folder.mkdir(parents=True)
    lines = [json.dumps({"OrderModelList": [{"orderNumber": str(n), "orderProgress": status}], "version": 9}) for n in range(15) for status in (100, 900)]
    (folder / "x.json").write_text("\n".join(lines))
    kept = documents.first_documents(documents.read_order_documents(spark, str(tmp_path / "raw"))).collect()
    assert {r.orderNumber: r.orderProgress for r in kept} == {str(n): "100" if n < 15 else "300" for n in range(20)} and len(kept) == 20


def test_copies_are_found_without_windows_and_documents_parsed_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    documents.write_order_documents(spark.createDataFrame([("1",)], "orderNumber string"), path, datetime(2024, 7, 3))
    staged = stage(spark, documents.read_order_documents(spark, path), "docs")
    plan = documents.first_documents(staged)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "row_number" not in plan and "FileScan json" not in plan


@pytest.mark.parametrize("times", [(1, 2), (2, 1), (1, 1)])
def test_file_times_do_not_matter(spark, tmp_path, times):
    """Of files of one landing the first by name counts, whichever was written or copied later."""
    for name, price, at in (("a.json", 1, times[0]), ("b.json", 3, times[1])):
        (tmp_path / name).write_text(json.dumps({"OrderModelList": [{"orderNumber": "a", "totalPrice": price}, {"orderNumber": "a", "totalPrice": price + 1}]}))
        os.utime(tmp_path / name, (1_700_000_000 + at, 1_700_000_000 + at))
    kept = documents.first_documents(documents.read_order_documents(spark, str(tmp_path))).collect()
    assert [r.totalPrice for r in kept] == ["1"]


def test_landings_of_one_month_go_by_their_ingest_time(spark, tmp_path):
    def docs(price):
        return spark.createDataFrame([(str(n), price) for n in range(30)], "orderNumber string, totalPrice string").repartition(4)

    path = str(tmp_path / "raw")
    for price, day in (("new", 9), ("old", 3)):  # the newer landing is written first
        documents.write_order_documents(docs(price), path, datetime(2024, 7, day), batch=7)
    kept = documents.first_documents(documents.read_order_documents(spark, path)).collect()
    assert len(kept) == 30 and {r.totalPrice for r in kept} == {"new"}


@pytest.mark.parametrize("value, flag", [(True, True), (False, False), (1, True), (0, False), ("2", True), ("", None), (None, None)])
def test_member_flags(spark, tmp_path, value, flag):
    docs = read(spark, tmp_path, {"orderNumber": "x", "orderDatetime": AT, "rakutenMemberFlag": value})
    assert flatten.normalize_orders(docs).first().rakuten_member_flag is flag


def test_documents_that_came_again_as_files_are_staged_once(spark, tmp_path, monkeypatch):
    """What is left of whole files is looked up in the staged documents; only numbers that came again apart, or very many files, are staged anew."""
    staged = []
    write = documents.stage
    monkeypatch.setattr(documents, "stage", lambda spark, df, label, codec=None: staged.append(label) or write(spark, df, label, codec))

    def land_twice(name, newer):
        path = str(tmp_path / name)
        for numbers, day, price in ((range(6), 3, "old"), (newer, 9, "new")):
            rows = spark.createDataFrame([(str(n), price) for n in numbers] + [(None, price)], "orderNumber string, totalPrice string").coalesce(1)
            documents.write_order_documents(rows, path, datetime(2024, 7, day))
        return documents.read_order_documents(spark, path)

    def found(docs):
        return sorted((r.orderNumber or "", r.totalPrice) for r in docs.collect())

    wanted = sorted([("", "old"), ("", "new")] + [(str(n), "new") for n in range(6)])
    again = land_twice("again", range(6))
    kept = documents.staged_once(again, "docs")
    assert found(kept) == wanted and staged.count("docs") == 1
    assert "GreaterThanOrEqual(source_landed,20240709000000)" in kept._jdf.queryExecution().sparkPlan().toString()
    staged.clear()
    monkeypatch.setattr(documents, "FEW_FILES", 1)
    assert found(documents.staged_once(again, "docs")) == wanted and staged.count("docs") == 2
    monkeypatch.undo()
    apart = documents.staged_once(land_twice("apart", range(3)), "docs")
    assert found(apart) == sorted([("", "old"), ("", "new")] + [(str(n), "new" if n < 3 else "old") for n in range(6)])
