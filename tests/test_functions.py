from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderloom.functions import calendar as cal
from orderloom.functions import scalars as s


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_instants(spark):
    texts = ["2024-06-24T13:40:33+0900", "2024-06-24T13:40:33+09:00", "2024-06-24T13:40:33", "", None, "soon"]
    at = datetime(2024, 6, 24, 4, 40, 33)
    assert values(spark, texts, lambda c: F.date_format(s.to_instant(c), "yyyy-MM-dd HH:mm:ss")) == [
        str(at), str(at), "2024-06-24 13:40:33", None, None, None,
    ]


def test_dates_are_utc_days(spark):
    texts = ["2024-07-08", "2024-07-08T03:00:00+0900", "", None, "soon"]
    assert values(spark, texts, s.to_utc_date) == [date(2024, 7, 8), date(2024, 7, 7), None, None, None]


def test_numbers(spark):
    assert values(spark, ["1650", "1650.0", "1.5E3", "", None, "-9999"], s.to_float) == [1650.0, 1650.0, 1500.0, None, None, -9999.0]
    assert values(spark, ["2", "2.0", "12.9", "", None], s.to_whole) == [2, 2, 12, None, None]
    for convert in (s.to_float, s.to_whole):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            values(spark, ["many"], convert)


def test_line_total(spark):
    rows = spark.createDataFrame([("1650", "2"), ("0.335", "3"), ("900.1", "7"), (None, "1"), ("5", None)], "p string, u string")
    assert [r[0] for r in rows.select(s.line_total(F.col("p"), F.col("u"))).collect()] == [3300.0, 1.01, 6300.7, None, None]


def test_zip(spark):
    rows = spark.createDataFrame([("158", "0094"), ("158", ""), ("", "0094"), (None, "0094"), ("158", None)], "a string, b string")
    assert [r[0] for r in rows.select(s.joined_zip(F.col("a"), F.col("b"))).collect()] == ["158-0094", None, None, None, None]


def test_stripping_knows_wide_spaces(spark):
    texts = ["　 a b　", "\t\n\xa0x\x1f", "　", "", None, "plain"]
    assert values(spark, texts, s.stripped) == ["a b", "x", None, None, None, "plain"]


def test_business_days_and_months(spark):
    rows = spark.createDataFrame(
        [("2024-06-30T14:59:59Z",), ("2024-06-30T15:00:00Z",), ("1969-12-31T15:00:00Z",), ("1969-12-31T14:59:59.5Z",)], "t string"
    ).select(F.col("t").cast("timestamp").alias("t"))
    seen = rows.select(cal.business_date(F.col("t")), cal.business_month(F.col("t"))).collect()
    assert [tuple(r) for r in seen] == [
        (date(2024, 6, 30), date(2024, 6, 1)),
        (date(2024, 7, 1), date(2024, 7, 1)),
        (date(1970, 1, 1), date(1970, 1, 1)),
        (date(1969, 12, 31), date(1969, 12, 1)),
    ]


def test_business_day_holds_under_any_session_zone(spark):
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = spark.sql("select timestamp'2024-06-30T15:00:00Z' as t").select(cal.business_date(F.col("t"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row[0] == date(2024, 7, 1)


def test_months_apart(spark):
    rows = spark.createDataFrame([(date(2024, 1, 1), date(2023, 11, 30)), (date(2023, 1, 1), date(2024, 3, 1))], "a date, b date")
    assert [r[0] for r in rows.select(cal.months_apart(F.col("a"), F.col("b"))).collect()] == [2, -14]


def test_iso_text(spark):
    row = spark.sql("select timestamp'2024-06-24T04:40:33Z' as t")
    assert tuple(row.select(cal.iso_local(F.col("t")), cal.iso_local(F.col("t"), True)).first()) == (
        "2024-06-24T13:40:33+0900", "2024-06-24T13:40:33+09:00",
    )


NOW = datetime(2024, 3, 15, 10, 30)


def test_spans():
    assert cal.resolve_span(now=NOW) == (datetime(2024, 2, 1), datetime(2024, 3, 1))
    assert cal.resolve_span("monthly", now=datetime(2024, 1, 3)) == (datetime(2023, 12, 1), datetime(2024, 1, 1))
    assert cal.resolve_span("HISTORICAL", now=NOW) == (datetime(2022, 3, 16, 10, 30), NOW)
    assert cal.resolve_span("CUSTOM", "2025-01-01", "2025-03-31") == (datetime(2025, 1, 1), datetime(2025, 4, 1))
    assert cal.resolve_span("anything else", now=NOW) == cal.resolve_span("MONTHLY", now=NOW)
    with pytest.raises(ValueError):
        cal.resolve_span("CUSTOM", "2025-01-01")
    assert cal.backfill_span(now=NOW) == (datetime(2022, 3, 1), NOW)
    assert cal.backfill_span("2024-01-01", "2024-06-30") == (datetime(2024, 1, 1), datetime(2024, 6, 30))
    with pytest.raises(ValueError):
        cal.backfill_span("2024-07-01", "2024-06-30")


def test_months_touched():
    full, partial = cal.months_touched("2024-02-01T00:00:00+09:00", "2024-04-11T00:00:00+09:00")
    assert (full, partial) == ([date(2024, 2, 1), date(2024, 3, 1)], [date(2024, 4, 1)])
    assert cal.months_touched("2024-01-31T15:00:00+00:00", "2024-02-29T15:00:00+00:00") == ([date(2024, 2, 1)], [])
    assert cal.months_touched("2024-02-01T00:00:00+09:00", "2024-02-01T00:00:00+09:00") == ([], [])
