from datetime import date, datetime

from pyspark.sql import functions as F

from orderloom.functions.calendar import resolve_span
from orderloom.operators import ranges
from orderloom.plans.jobs import dry_run


def cut(spark, start, end):
    rows = ranges.monthly_ranges(ranges.span_table(spark, (start, end))).orderBy("month").collect()
    return [(r.range_start, r.range_end) for r in rows]


def test_start_snaps_back_and_end_is_cut(spark):
    assert cut(spark, datetime(2024, 1, 15), datetime(2024, 3, 10, 12)) == [
        (datetime(2024, 1, 1), datetime(2024, 2, 1)),
        (datetime(2024, 2, 1), datetime(2024, 3, 1)),
        (datetime(2024, 3, 1), datetime(2024, 3, 10, 12)),
    ]


def test_borders(spark):
    assert cut(spark, datetime(2024, 1, 1), datetime(2024, 2, 1)) == [(datetime(2024, 1, 1), datetime(2024, 2, 1))]
    assert cut(spark, datetime(2024, 1, 1), datetime(2024, 1, 1)) == []
    assert cut(spark, datetime(2024, 1, 20), datetime(2024, 1, 20)) == [(datetime(2024, 1, 1), datetime(2024, 1, 20))]
    assert cut(spark, datetime(2024, 5, 1), datetime(2024, 1, 1)) == []
    assert len(cut(spark, *resolve_span("HISTORICAL", now=datetime(2024, 3, 15)))) == 25


def test_weekly_chunks(spark):
    whole = ranges.monthly_ranges(ranges.span_table(spark, (datetime(2024, 2, 1), datetime(2024, 3, 1))))
    chunks = ranges.weekly_chunks(whole).orderBy("chunk_start").collect()
    assert [(c.chunk_start.day, c.chunk_end) for c in chunks] == [
        (1, datetime(2024, 2, 8)), (8, datetime(2024, 2, 15)), (15, datetime(2024, 2, 22)),
        (22, datetime(2024, 2, 29)), (29, datetime(2024, 3, 1)),
    ]


def placed(spark, rows):
    return spark.createDataFrame(rows, "order_number string, t string").select(
        "order_number", F.col("t").cast("timestamp").alias("order_datetime")
    )


def test_counts_are_distinct_and_keep_empty_ranges(spark):
    orders = placed(spark, [
        ("a", "2024-01-31T14:59:59Z"), ("b", "2024-01-31T15:00:00Z"), ("b", "2024-02-02T00:00:00Z"),
        ("c", "2024-04-09T15:00:00Z"), ("d", "2024-04-09T14:59:59Z"),
    ])
    months = ranges.monthly_ranges(ranges.span_table(spark, (datetime(2024, 1, 1), datetime(2024, 4, 10))))
    counts = ranges.order_counts(orders, months)
    assert [r.order_numbers for r in counts.orderBy("month").collect()] == [1, 1, 0, 1]
    assert tuple(ranges.run_totals(counts).first()) == (4, 3)
    weeks = {str(r.chunk_start)[:10]: (r.order_numbers, r.over_cap) for r in ranges.chunk_counts(orders, months).collect()}
    assert weeks["2024-01-29"] == (1, False) and weeks["2024-02-01"] == (1, False) and weeks["2024-04-08"] == (1, False)
    assert len(weeks) == 5 + 5 + 5 + 2


def test_backfill_plan_leaves_the_end_day_out(spark):
    months = ranges.monthly_ranges(ranges.span_table(spark, (datetime(2024, 5, 1), datetime(2024, 6, 30))))
    assert [tuple(r) for r in ranges.backfill_plan(months).orderBy("month").collect()] == [
        ("2024-05", date(2024, 5, 1), date(2024, 5, 31)),
        ("2024-06", date(2024, 6, 1), date(2024, 6, 29)),
    ]


def test_dry_run(spark):
    orders = placed(spark, [("a", "2024-02-10T00:00:00Z"), ("b", "2024-03-10T00:00:00Z")])
    assert [tuple(r) for r in dry_run(spark, orders, now=datetime(2024, 3, 15)).collect()] == [
        ("2024-02-01T00:00:00+0900", "2024-03-01T00:00:00+0900", 1)
    ]
