"""What no registered query may hold in its plan, whatever the size of the tables."""

import re

import pytest

from pyspark.sql import functions as F

from orderloom.operators import flatten
from orderloom.operators.numbering import numbered, numbered_as_they_lie
from orderloom.plans import catalogue, given_tables
from orderloom.plans.catalogue import QUERIES
from orderloom.session import stage

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "MapInArrow", "collect_list", "collect_set"]
# a total over a table: one row per task meets in one
TOTALS = {"month_ranges", "range_order_counts", "chunk_counts", "backfill_plan", "run_summary", "reject_report", "table_freshness"}


# a job's result is read back from its tables, so that its own plans are those of the other queries
@pytest.mark.parametrize("name", sorted(name for name in QUERIES if not name.startswith("job_")))
def test_plan(name, spark):
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if every table were large
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [word for word in FORBIDDEN if word in plan]
    if name not in TOTALS:
        assert "SinglePartition" not in plan
    # a window runs per key, and a ranking is cut down before its shuffle
    assert not re.search(r"Window \[.*windowspecdefinition\(specifiedwindowframe", plan)
    assert plan.count("row_number()") == 0 or "WindowGroupLimit" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["delete_between"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan
    plan = QUERIES["product_master_best"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Not(In(p_brand" in plan.replace("IsNotNull(p_brand), ", "")


def test_items_meet_their_orders_before_they_get_texts(spark):
    """What is shuffled to find an item's time has no product text in it, and the rows are those of the plain join."""
    sf_dir = "/root/testdata/sf0.001"
    orders = given_tables.shop_orders(spark, sf_dir)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        timed = given_tables.timed_items(spark, sf_dir, orders)
        plan = timed._jdf.queryExecution().optimizedPlan().toString()
        # the join with the product is above the join with the order: its tree starts with fewer marks
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert len(joins) == 2 and "order_number" in joins[1] and "l_partkey" in joins[0]
        plain = flatten.attach_order_datetime(given_tables.shop_items(spark, sf_dir), orders)
        assert sorted(map(str, timed.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_refreshed_cohorts_join_their_items_once(spark, monkeypatch):
    seen = []

    def staged(session, rows, label, **options):
        seen.append(label)
        if label == "timed-items":
            raise InterruptedError(label)  # what follows is tested with the query
        return stage(session, rows, label, **options)

    monkeypatch.setattr(catalogue, "stage", staged)
    with pytest.raises(InterruptedError):
        catalogue.QUERIES["job_refresh_cohorts"](spark, "/root/testdata/sf0.001")
    assert seen == ["timed-items"]


@pytest.mark.parametrize("n", [0, 1, 1003])
def test_numbers_are_gapless_without_a_join(spark, n):
    rows = spark.range(0, 2 * n, 2, 7).withColumn("text", F.concat(F.lit("t"), "id")).where("id % 3 <> 1 or id < 500")
    wanted = rows.count()
    for placed in (numbered(rows, [F.col("id").desc()], "test"), numbered_as_they_lie(rows, "test")):
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
        assert sorted(r.position for r in placed.collect()) == list(range(wanted))
    ordered = [r.id for r in numbered(rows, [F.col("id").desc()], "test").orderBy("position").collect()]
    assert ordered == sorted(ordered, reverse=True)
