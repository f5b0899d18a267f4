"""The landing folder as a stream."""

import json
from datetime import datetime

import pytest

from orderloom import tabled
from orderloom.plans import jobs
from orderloom.sources import documents
from orderloom.streaming import landing

RUN = datetime(2024, 7, 1, 3)


def order(number, placed, price, *items):
    return {
        "orderNumber": number, "orderProgress": 300, "orderDatetime": placed, "totalPrice": price, "OrdererModel": {"emailAddress": "u"},
        "PackageModelList": [{"basketId": 1, "ItemModelList": [{"itemId": i, "manageNumber": "m", "priceTaxIncl": 1, "units": 1} for i in items]}],
    }


STEPS = [
    [order("1", "2024-01-05T10:00:00+0900", 100, 1, 2), order("2", "2024-01-31T23:30:00+0900", 50, 3)],
    [order("1", "2024-01-05T10:00:00+0900", 90, 1), order("3", "2024-02-01T00:00:00+0900", 70, 4, 4)],
    [order("2", "2024-02-02T10:00:00+0900", 55, 5), order("4", "2024-03-01T10:00:00+0900", 5)],
]


def land(folder, step, name="x"):
    target = folder / "raw" / "year=2024" / "month=07" / f"landing=202407{step + 1:02d}000000"
    target.mkdir(parents=True, exist_ok=True)
    (target / f"{name}.json").write_text(json.dumps({"OrderModelList": STEPS[step], "version": 9}))


def content(spark, house):
    orders = house.read(spark, "orders").select("order_number", "total_price", "order_month").collect()
    items = house.read(spark, "order_items").select("order_number", "item_id", "order_month").collect()
    return sorted(map(tuple, orders)), sorted(map(tuple, items))


@pytest.fixture
def house(spark, tmp_path):
    house = jobs.Warehouse(str(tmp_path / "house"))
    house.create(spark)
    return house


def follow(spark, house, folder, **options):
    query = landing.follow_landings(spark, house, str(folder / "raw"), str(folder / "checkpoint"), run_at=RUN, **options)
    query.awaitTermination()
    return query


def test_three_steps_equal_one_load(spark, house, tmp_path):
    for step in range(3):
        land(tmp_path, step)
        follow(spark, house, tmp_path)
    streamed = content(spark, house)
    assert tabled.note(spark, house.path("orders"), "stream.landing.batch") == "2"
    follow(spark, house, tmp_path)  # nothing landed
    assert content(spark, house) == streamed

    whole = jobs.Warehouse(str(tmp_path / "whole"))
    whole.create(spark)
    docs = documents.read_order_documents(spark, str(tmp_path / "raw"))
    jobs.load_span(spark, whole, docs, datetime(2024, 1, 1), datetime(2024, 4, 1), RUN)
    assert content(spark, whole) == streamed
    assert [(r[0], r[1]) for r in streamed[0]] == [("1", 90.0), ("2", 55.0), ("3", 70.0), ("4", 5.0)]

    # a batch that comes again: after it was noted it is passed over, before that it gives the same rows
    land(tmp_path / "again", 2)
    last = documents.read_order_documents(spark, str(tmp_path / "again" / "raw"))
    assert landing.apply_batch(spark, house, last, 2, run_at=RUN) is False
    for _ in range(2):
        assert landing.apply_batch(spark, house, last, 3, run_at=RUN) is True
        tabled.note(spark, house.path("orders"), "stream.landing.batch", "2")
        assert content(spark, house) == streamed


def test_bad_documents_stop_the_batch_or_are_put_aside(spark, house, tmp_path):
    land(tmp_path, 0)
    broken = {"OrderModelList": [order("9", "soon", 1, 1)], "version": 9}
    (tmp_path / "raw" / "year=2024" / "month=07" / "bad.json").write_text(json.dumps(broken))
    with pytest.raises(Exception, match="order_datetime_unreadable"):
        follow(spark, house, tmp_path)
    assert content(spark, house) == ([], [])
    follow(spark, house, tmp_path, quarantine=str(tmp_path / "bad"))
    assert [r[0] for r in content(spark, house)[0]] == ["1", "2"]
    assert [r.orderNumber for r in spark.read.json(str(tmp_path / "bad" / "*")).collect()] == ["9"]
