"""The jobs end to end on landed JSON."""

import json
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from orderloom import session
from orderloom.functions.calendar import resolve_span
from orderloom.plans import jobs
from orderloom.sources.documents import read_order_documents

RUN = datetime(2024, 7, 1, 3)


def order(number, user, placed, price, *items, status=300):
    return {
        "orderNumber": number, "orderProgress": status, "orderDatetime": placed, "totalPrice": price,
        "OrdererModel": {"emailAddress": user},
        "PackageModelList": [
            {"basketId": 1, "ItemModelList": [
                {"itemId": 1, "manageNumber": product, "itemName": name, "priceTaxIncl": cost, "units": 1} for product, name, cost in items
            ]}
        ],
    }


JANUARY = [
    order("1", "ann", "2024-01-05T10:00:00+0900", 100, ("m1", "cup", 60), ("m2", "pot", 40)),
    order("2", "bob", "2024-01-31T23:30:00+0900", 50, ("m9", "old name", 50)),
    order("3", "ann", "2024-01-20T10:00:00+0900", 30, ("m2", "pot", 30), status=900),
]
FEBRUARY = [
    order("4", "ann", "2024-02-01T00:00:00+0900", 70, ("m1", "cup", 70)),
    order("5", "cat", "2024-02-10T10:00:00+0900", 20, ("m1", "cup", 20)),
]


class Shop:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.landed = spark, folder, 0
        self.house = jobs.Warehouse(str(folder / "warehouse"))

    def docs(self, orders):
        self.landed += 1
        file = self.folder / f"landed-{self.landed}.json"
        file.write_text(json.dumps({"OrderModelList": orders, "version": 9}))
        return read_order_documents(self.spark, str(file))

    def month(self, orders, month, **options):
        start = datetime(2024, month, 1)
        return jobs.process_span(self.spark, self.house, self.docs(orders), start, datetime(2024, month + 1, 1), RUN, **options)

    def rows(self, table, *columns):
        return sorted(map(tuple, self.house.read(self.spark, table).select(*columns).collect()), key=str)

    def ltv(self):
        return self.rows(
            "entry_product_ltv_by_month_offset", "entry_manage_number", "entry_item_name", "first_order_month",
            "month_offset", "cohort_users", "active_buyers", "revenue_in_month", "cumulative_revenue",
        )


@pytest.fixture
def shop(spark, tmp_path):
    shop = Shop(spark, tmp_path)
    assert len(shop.house.create(spark)) == 5 and shop.house.create(spark) == []
    master = spark.createDataFrame([("m1", "Cup", "kitchen", "B")], "manage_number string, product_name string, category_name string, brand_name string")
    result = jobs.sync_master(spark, shop.house, master, "test")
    assert (result["status"], result["rows"]) == ("success", 1)
    return shop


LTV = [
    ("m1", "Cup", date(2024, 1, 1), 0, 1, 1, 100.0, 100.0),
    ("m1", "Cup", date(2024, 1, 1), 1, 1, 1, 70.0, 170.0),
    ("m1", "Cup", date(2024, 2, 1), 0, 1, 1, 20.0, 20.0),
    ("m9", "old name", date(2024, 1, 1), 0, 1, 1, 50.0, 50.0),
]


def test_two_months_and_a_rerun(shop):
    first = shop.month(JANUARY, 1)
    assert (first["orders_rows"], first["order_items_rows"]) == (3, 4)
    assert first["first_purchase_update"] == {"inserted_users": 2, "month": "2024-01-01"}
    assert shop.month(FEBRUARY, 2)["first_purchase_update"]["inserted_users"] == 1
    assert shop.ltv() == LTV
    assert shop.month(FEBRUARY, 2)["first_purchase_update"]["inserted_users"] == 0
    assert shop.ltv() == LTV
    assert [n for n, in shop.rows("orders", "order_number")] == list("12345")
    assert shop.rows("user_first_purchase_info", "user_email", "first_order_number", "entry_manage_number", "entry_item_name", "category_name") == [
        ("ann", "1", "m1", "Cup", None), ("bob", "2", "m9", "old name", None), ("cat", "5", "m1", "Cup", None),
    ]


def test_known_users_stay_until_the_full_load(shop):
    shop.month(FEBRUARY, 2)
    late = shop.month(JANUARY, 1)  # months out of order: ann is already known from February
    assert late["first_purchase_update"]["inserted_users"] == 1
    assert ("ann", "4") in shop.rows("user_first_purchase_info", "user_email", "first_order_number")
    for _ in range(2):
        assert jobs.initial_load(shop.spark, shop.house, RUN) == {"users": 3}
        assert ("ann", "1") in shop.rows("user_first_purchase_info", "user_email", "first_order_number")
        assert shop.ltv() == LTV


def test_backfill_equals_month_by_month(shop):
    span = (datetime(2024, 1, 10), datetime(2024, 3, 1))  # the start snaps back to the month
    result = jobs.backfill(shop.spark, shop.house, shop.docs(JANUARY + FEBRUARY), span, RUN)
    assert (result["ranges_count"], result["users"], result["orders_rows"]) == (2, 3, 5)
    assert [(m["month"], m["orders_rows"]) for m in result["months"]] == [("2024-01-01", 3), ("2024-02-01", 2)]
    assert shop.ltv() == LTV


def test_empty_input_leaves_the_month(shop):
    shop.month(JANUARY, 1)
    assert shop.month([], 1)["note"] == "no_orders_skip"
    assert len(shop.rows("orders", "order_number")) == 3


def test_rejected_documents_leave_the_month(shop):
    shop.month(JANUARY, 1)
    bad = order("6", "dan", "soon", 1, ("m1", "cup", 1))
    with pytest.raises(ValueError, match="order_datetime_unreadable"):
        shop.month([*JANUARY, bad], 1)
    assert len(shop.rows("orders", "order_number")) == 3


def test_a_failing_derived_job_leaves_the_load(shop, monkeypatch):
    monkeypatch.setattr(jobs, "merge_first_purchases", lambda *_: 1 / 0)
    result = shop.month(JANUARY, 1, skip_ltv=True)
    assert result["first_purchase_update"]["status"] == "error" and "ltv_update" not in result
    assert len(shop.rows("orders", "order_number")) == 3


def test_repeated_orders_count_once(shop):
    shop.month([*JANUARY, *JANUARY], 1)
    assert len(shop.rows("orders", "order_number")) == 3 and len(shop.rows("order_items", "order_number")) == 4


def test_items_carry_the_order_time(shop):
    shop.month(JANUARY, 1)
    assert shop.rows("order_items", "order_number", "order_datetime", "order_month")[0] == ("1", datetime(2024, 1, 5, 1), date(2024, 1, 1))


def test_new_names_reach_the_cohort_table(shop):
    shop.month(JANUARY, 1)
    master = shop.spark.createDataFrame([(" m1", "Mug", "kitchen", "B"), ("m9", "Bowl", "", None)], "manage_number string, product_name string, category_name string, brand_name string")
    result = jobs.sync_master_and_names(shop.spark, shop.house, master, "sheet")
    assert result["master_sync"]["status"] == "success" and result["ltv_names_updated"] == {"updated_rows": 2}
    assert {r[1] for r in shop.ltv()} == {"Mug", "Bowl"}
    assert jobs.refresh_ltv_names(shop.spark, shop.house) == {"updated_rows": 0}
    assert len(shop.ltv()) == 2


def test_master_sync_statuses(shop):
    spark, house = shop.spark, shop.house
    empty = spark.createDataFrame([(" ", "x")], "manage_number string, product_name string")
    assert jobs.sync_master(spark, house, None) == {"status": "skipped", "reason": "no_source"}
    assert jobs.sync_master(spark, house, empty, "s") == {"status": "skipped", "reason": "empty_master", "source": "s"}
    for source in (None, empty):
        with pytest.raises(ValueError):
            jobs.sync_master(spark, house, source, required=True)
    other = spark.createDataFrame([("m5", "x")], "manage_number string, product_name string")
    assert jobs.sync_master(spark, house, other, dry_run=True)["status"] == "dry_run"
    assert shop.rows("product_master_raw", "manage_number") == [("m1",)]
    broken = other.selectExpr("manage_number", "cast(raise_error('gone') as string) as product_name")
    assert jobs.sync_master(spark, house, broken)["status"] == "error"
    with pytest.raises(Exception, match="gone"):
        jobs.sync_master(spark, house, broken, required=True)
    assert shop.rows("product_master_raw", "manage_number") == [("m1",)]


def test_custom_span_ends_inside_a_month(shop):
    shop.month(JANUARY, 1)
    start, end = resolve_span("CUSTOM", "2024-01-01", "2024-01-20")
    jobs.load_span(shop.spark, shop.house, shop.docs([order("7", "eve", "2024-01-02T00:00:00+0900", 1, ("m1", "cup", 1))]), start, end, RUN)
    assert [n for n, in shop.rows("orders", "order_number")] == ["2", "7"]


def test_run_by_mode(shop):
    master = shop.spark.createDataFrame([("m1", "Cup", "kitchen", "B")], "manage_number string, product_name string, category_name string, brand_name string")
    result = jobs.run(
        shop.spark, shop.house, shop.docs(JANUARY + FEBRUARY), "custom", "2024-01-15", "2024-02-29", master=master, run_at=RUN
    )
    assert (result["mode"], result["ranges_count"], result["master_sync"]["status"]) == ("CUSTOM", 2, "success")
    assert result["first_purchase_update"] == {"inserted_users": 3, "month": "2024-01-01"}
    assert shop.ltv() == LTV
    monthly = jobs.run(shop.spark, shop.house, shop.docs(FEBRUARY), now=datetime(2024, 3, 15), run_at=RUN)
    assert (monthly["ranges_count"], monthly["first_purchase_update"]["inserted_users"]) == (1, 0)
    assert shop.ltv() == LTV


def test_months_quarantine_and_lost_orders(shop, tmp_path):
    span = (datetime(2024, 1, 1), datetime(2024, 3, 1))
    bad = order("6", "dan", "soon", 1, ("m1", "cup", 1))
    searched = shop.spark.createDataFrame([(n,) for n in "123456"] + [("7",)], "order_number string")
    args = shop.spark, shop.house, shop.docs([*JANUARY, *FEBRUARY, bad]), *span, RUN
    with pytest.raises(ValueError, match="1 order numbers were found but not fetched"):
        jobs.load_span(*args, searched=searched)
    assert shop.rows("orders", "order_number") == []
    kept = str(tmp_path / "quarantine")
    result = jobs.load_span(*args, searched=searched.where("order_number <> '7'"), quarantine=kept)
    assert result["rejected"] == {"order_datetime_unreadable": 1} and result["orders_rows"] == 5
    assert result["months"] == [
        {"month": "2024-01-01", "orders_rows": 3, "order_items_rows": 4}, {"month": "2024-02-01", "orders_rows": 2, "order_items_rows": 2},
    ]
    assert [r.orderNumber for r in shop.spark.read.json(kept).collect()] == ["6"]


def test_jobs_leave_no_scratch(shop, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_LOCAL_ROOTS", [SimpleNamespace(name=str(tmp_path / "scratch"))])
    (tmp_path / "scratch").mkdir()
    shop.month(JANUARY, 1)
    with pytest.raises(ValueError):
        shop.month([order("6", "dan", "soon", 1)], 1)
    assert jobs.initial_load(shop.spark, shop.house, RUN) == {"users": 2}
    assert list((tmp_path / "scratch").iterdir()) == []


def test_cancelled_statuses_are_a_parameter(shop):
    shop.month(JANUARY, 1)
    assert jobs.rebuild_first_purchases(shop.spark, shop.house, RUN, cancelled=("300",)) == 1
    assert shop.rows("user_first_purchase_info", "user_email", "first_order_number") == [("ann", "3")]


def test_a_failed_rebuild_keeps_the_tables(shop, monkeypatch):
    shop.month(JANUARY, 1)
    before = shop.ltv(), shop.rows("user_first_purchase_info", "user_email")
    monkeypatch.setattr(jobs, "_stamped", lambda rows, _: rows.withColumn("updated_at", F.raise_error(F.lit("gone")).cast("timestamp")))
    for job in (jobs.rebuild_first_purchases, jobs.rebuild_ltv):
        with pytest.raises(Exception, match="gone"):
            job(shop.spark, shop.house, RUN)
    assert (shop.ltv(), shop.rows("user_first_purchase_info", "user_email")) == before


MARCH = [
    order("8", "ann", "2024-03-03T10:00:00+0900", 15, ("m2", "pot", 15)),
    order("9", "dan", "2024-03-04T10:00:00+0900", 25, ("m2", "pot", 25)),
]


def files_by_month(shop):
    rows = shop.house.read(shop.spark, "entry_product_ltv_by_month_offset").selectExpr("first_order_month", "_metadata.file_path as file")
    out = {}
    for month, file in rows.distinct().collect():
        out.setdefault(str(month), set()).add(file)
    return out


def test_cohorts_kept_up_to_date_equal_a_rebuild(shop):
    for month, orders in ((1, JANUARY), (2, FEBRUARY), (3, MARCH)):
        before = files_by_month(shop)
        result = shop.month(orders, month, incremental=True)
        found, touched = shop.ltv(), result["ltv_update"]["first_months"]
        after = files_by_month(shop)
        # first months without a buyer in the loaded one keep their files
        assert all(after[m] == before[m] for m in before if m not in touched)
        jobs.rebuild_ltv(shop.spark, shop.house, RUN)
        assert found == shop.ltv()
    assert touched == ["2024-01-01", "2024-03-01"]  # nobody of February bought in March
    # a month loaded again with fewer orders, and a month before all others
    for month, orders in ((2, FEBRUARY[:1]), (3, MARCH[:1])):
        shop.month(orders, month, incremental=True)
        found = shop.ltv()
        jobs.rebuild_ltv(shop.spark, shop.house, RUN)
        assert found == shop.ltv()


def test_months_out_of_order_equal_a_rebuild(shop):
    """A user of an earlier month that is loaded later has orders in months that did not change."""
    shop.month([order("20", "eve", "2024-02-05T10:00:00+0900", 9, ("", "no key", 9)) | {"PackageModelList": None}, *FEBRUARY], 2, incremental=True)
    shop.month([order("21", "eve", "2024-01-05T10:00:00+0900", 5, ("m1", "cup", 5)), *JANUARY], 1, incremental=True)
    found = shop.ltv()
    jobs.rebuild_ltv(shop.spark, shop.house, RUN)
    assert found == shop.ltv() and any(r[2] == date(2024, 1, 1) and r[3] == 1 for r in found)


def test_cancelled_statuses_reach_every_job(shop):
    shop.month(JANUARY, 1, cancelled=("300",))
    assert shop.rows("user_first_purchase_info", "user_email", "first_order_number") == [("ann", "3")]
    assert [(r[0], r[6]) for r in shop.ltv()] == [("m2", 30.0)]
    assert jobs.initial_load(shop.spark, shop.house, RUN, cancelled=("300",)) == {"users": 1}
    assert [(r[0], r[6]) for r in shop.ltv()] == [("m2", 30.0)]


def test_tables_are_read_by_sql(shop):
    shop.month(JANUARY, 1)
    sql = f"SELECT count(*) FROM {shop.house.name('orders')} o JOIN {shop.house.name('order_items')} i ON o.order_number = i.order_number"
    assert shop.spark.sql(sql).first()[0] == 4
    shop.month(JANUARY[:1], 1)
    assert shop.spark.sql(sql).first()[0] == 2
