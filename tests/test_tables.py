import math
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom import schemas, tabled
from orderloom.operators import merges, tables
from orderloom.schemas import INSTANT, NUMBER, TEXT, table

FACTS = table(required={"order_number"}, order_number=TEXT, order_datetime=INSTANT, total_price=NUMBER)


def facts(spark, rows):
    df = spark.createDataFrame(rows, "order_number string, t string, total_price double")
    return df.select("order_number", F.col("t").cast("timestamp").alias("order_datetime"), "total_price")


def content(spark, path):
    rows = schemas.read_table(spark, path, FACTS, "order_month").collect()
    return sorted((r.order_number, r.total_price, str(r.order_month)) for r in rows)


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "facts")
    assert schemas.ensure_table(spark, path, FACTS, "order_month") is True
    tables.load(spark, facts(spark, [
        ("jan", "2024-01-31T14:59:59Z", 1.0), ("feb", "2024-01-31T15:00:00Z", 2.0),
        ("feb2", "2024-02-29T14:59:59Z", 3.0), ("mar", "2024-02-29T15:00:00Z", 4.0),
        ("late", "2024-03-20T00:00:00Z", 5.0),
    ]), path, FACTS, partition="order_month", ts_column="order_datetime")
    return path


START = [("feb", 2.0, "2024-02-01"), ("feb2", 3.0, "2024-02-01"), ("jan", 1.0, "2024-01-01"), ("late", 5.0, "2024-03-01"), ("mar", 4.0, "2024-03-01")]
FEBRUARY = ("2024-02-01T00:00:00+09:00", "2024-03-01T00:00:00+09:00")


def replace(spark, path, rows, span):
    tables.replace_range(spark, path, FACTS, facts(spark, rows), "order_datetime", *span)


def test_ensure_table_keeps_rows(spark, path):
    assert schemas.ensure_table(spark, path, FACTS, "order_month") is False
    assert content(spark, path) == START


def test_replace_full_month_twice(spark, path):
    for _ in range(2):
        replace(spark, path, [("new", "2024-02-10T00:00:00Z", 9.0)], FEBRUARY)
        assert content(spark, path) == sorted([("new", 9.0, "2024-02-01")] + [r for r in START if r[2] != "2024-02-01"])


def test_replace_by_nothing_clears_the_month(spark, path):
    replace(spark, path, [], FEBRUARY)
    assert content(spark, path) == [r for r in START if r[2] != "2024-02-01"]


def test_replace_part_of_a_month_keeps_the_rest(spark, path):
    replace(spark, path, [("new", "2024-03-02T00:00:00Z", 9.0)], ("2024-02-01T00:00:00+09:00", "2024-03-11T00:00:00+09:00"))
    assert content(spark, path) == [("jan", 1.0, "2024-01-01"), ("late", 5.0, "2024-03-01"), ("new", 9.0, "2024-03-01")]


def test_incoming_rows_of_other_months_are_appended(spark, path):
    replace(spark, path, [("in", "2024-02-10T00:00:00Z", 9.0), ("jan3", "2024-01-03T00:00:00Z", 8.0), ("none", None, 7.0)], FEBRUARY)
    assert content(spark, path) == sorted(
        [("in", 9.0, "2024-02-01"), ("jan3", 8.0, "2024-01-01"), ("none", 7.0, "None")] + [r for r in START if r[2] != "2024-02-01"]
    )


def test_bad_rows_leave_the_table_alone(spark, path):
    with pytest.raises(Exception, match="required column order_number is null"):
        replace(spark, path, [("ok", "2024-02-10T00:00:00Z", 1.0), (None, "2024-02-10T00:00:00Z", 9.0)], FEBRUARY)
    assert content(spark, path) == START


def test_delete_range(spark, path):
    tables.delete_range(spark, path, FACTS, "order_datetime", "2024-02-29T14:59:59+00:00", "2024-02-29T15:00:00+00:00")
    assert content(spark, path) == [r for r in START if r[0] != "feb2"]


def test_rows_without_time_survive_a_delete(spark):
    rows = facts(spark, [("none", None, 1.0), ("in", "2024-02-10T00:00:00Z", 1.0), ("end", "2024-02-29T15:00:00Z", 1.0)])
    left = merges.delete_between(rows, "order_datetime", *FEBRUARY)
    assert sorted(r.order_number for r in left.collect()) == ["end", "none"]


def test_dispositions(spark, path):
    one = facts(spark, [("x", "2024-05-01T00:00:00Z", 1.0)])
    none = one.where("false")
    args = dict(partition="order_month", ts_column="order_datetime")
    for mode in ("WRITE_APPEND", "WRITE_TRUNCATE"):
        assert tables.load(spark, none, path, FACTS, mode, **args) is False
    assert content(spark, path) == START
    with pytest.raises(ValueError, match="no rows"):
        tables.load(spark, none, path, FACTS, ignore_if_empty=False, **args)
    with pytest.raises(ValueError, match="already has rows"):
        tables.load(spark, one, path, FACTS, "WRITE_EMPTY", **args)
    with pytest.raises(ValueError, match="unknown disposition"):
        tables.load(spark, one, path, FACTS, "WRITE_MAYBE", **args)
    assert tables.load(spark, one, path, FACTS, "WRITE_TRUNCATE", **args) is True
    assert content(spark, path) == [("x", 1.0, "2024-05-01")]


def test_write_if_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    schemas.ensure_table(spark, path, FACTS)
    tables.load(spark, facts(spark, [("x", None, 1.0)]), path, FACTS, "WRITE_EMPTY")
    assert schemas.read_table(spark, path, FACTS).count() == 1


def test_declared_table(spark, path):
    schemas.declare_table(spark, "facts_declared", path)
    schemas.declare_table(spark, "facts_declared", path)
    try:
        assert spark.table("facts_declared").where("order_month = date'2024-03-01'").count() == 2
        replace(spark, path, [("new", "2024-02-10T00:00:00Z", 9.0)], FEBRUARY)
        for name in ("facts_declared", tabled.identifier(path)):  # SQL reads the newest content
            assert spark.sql(f"SELECT order_number FROM {name} WHERE order_month = date'2024-02-01'").collect() == [("new",)]
    finally:
        spark.catalog.dropTempView("facts_declared")


TARGET = [("a", "x", 1), ("b", "y", 2), (None, "z", 3), ("d", "d", 4)]


def upserted(spark, source, columns):
    target = spark.createDataFrame(TARGET, "k string, v string, only_target int")
    return sorted(map(tuple, merges.upsert_by_keys(target, spark.createDataFrame(source, columns), ["k"]).collect()), key=str)


def test_upsert(spark):
    assert upserted(spark, [("a", "new"), ("b", None), ("c", "in"), (None, "in")], "k string, v string") == sorted(
        [("a", "new", 1), ("b", None, 2), (None, "z", 3), ("d", "d", 4), ("c", "in", None), (None, "in", None)], key=str
    )


def test_upsert_duplicates(spark):
    with pytest.raises(Exception, match="several source rows match"):
        upserted(spark, [("a", "1"), ("a", "2")], "k string, v string")
    both = upserted(spark, [("n", "1"), ("n", "2"), (None, "3"), (None, "4")], "k string, v string")
    assert [r for r in both if r[2] is None] == sorted([("n", "1", None), ("n", "2", None), (None, "3", None), (None, "4", None)], key=str)


def test_upsert_checks_columns(spark):
    with pytest.raises(ValueError, match="no column w"):
        upserted(spark, [("a", 1)], "k string, w int")
    with pytest.raises(ValueError, match="no key column k"):
        upserted(spark, [("a",)], "v string")


def test_upsert_table_moves_rows_between_months(spark, path):
    source = facts(spark, [("feb", "2024-06-05T00:00:00Z", 20.0), ("feb2", "2024-02-03T00:00:00Z", 30.0)])
    for _ in range(2):
        assert tables.upsert(spark, path, FACTS, source, ["order_number"], "order_month", "order_datetime") is True
        assert content(spark, path) == sorted(
            [("feb", 20.0, "2024-06-01"), ("feb2", 30.0, "2024-02-01")] + [r for r in START if r[2] != "2024-02-01"]
        )
    assert tables.upsert(spark, path, FACTS, source.where("false"), ["order_number"], "order_month", "order_datetime") is False


def test_conform(spark):
    rows = spark.createDataFrame([("a", 1)], "order_number string, total_price int").withColumn("extra", F.lit(1))
    out = schemas.conform(rows, FACTS)
    assert out.dtypes == [("order_number", "string"), ("order_datetime", "timestamp"), ("total_price", "double")]
    assert out.first() == ("a", None, 1.0)


def test_months_of_written_rows(spark, path):
    months = {r.order_month for r in schemas.read_table(spark, path, FACTS, "order_month").collect()}
    assert months == {date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)}


def files_of(path):
    return {str(p) for p in Path(path).rglob("part-*.parquet")}


def failing(spark, rows):
    """The rows, and a job that fails on the last of them after the others are written."""
    return facts(spark, rows).withColumn("total_price", F.expr("if(total_price < 0, raise_error('gone'), total_price)").cast("double"))


def test_a_failed_write_changes_nothing(spark, path):
    args = dict(partition="order_month", ts_column="order_datetime")
    rows = [("x", "2024-02-10T00:00:00Z", 9.0), ("feb", "2024-02-11T00:00:00Z", -1.0)]
    for attempt in (
        lambda: tables.load(spark, failing(spark, rows), path, FACTS, "WRITE_TRUNCATE", **args),
        lambda: tables.load(spark, failing(spark, rows), path, FACTS, **args),
        lambda: tables.replace_range(spark, path, FACTS, failing(spark, rows), "order_datetime", *FEBRUARY),
        lambda: tables.upsert(spark, path, FACTS, failing(spark, rows), ["order_number"], "order_month", "order_datetime"),
        lambda: tables.replace_table(spark, tables.with_month(failing(spark, rows), "order_datetime", "order_month"), path, FACTS, "order_month"),
    ):
        with pytest.raises(Exception, match="gone"):
            attempt()
        assert content(spark, path) == START
    tables.load(spark, facts(spark, rows[:1]), path, FACTS, "WRITE_TRUNCATE", **args)
    assert tabled.purge(spark, path, "order_month") >= 1 and tabled.purge(spark, path, "order_month") == 0
    assert content(spark, path) == [("x", 9.0, "2024-02-01")]


def test_tables_switch_together(spark, path, tmp_path):
    other = str(tmp_path / "other")
    schemas.ensure_table(spark, other, FACTS, "order_month")
    good, bad = facts(spark, [("new", "2024-02-10T00:00:00Z", 9.0)]), failing(spark, [("bad", "2024-02-10T00:00:00Z", -1.0)])
    with pytest.raises(Exception, match="gone"):
        tables.replace_ranges(spark, {path: (FACTS, good), other: (FACTS, bad)}, "order_datetime", *FEBRUARY)
    assert content(spark, path) == START and content(spark, other) == []
    tables.replace_ranges(spark, {path: (FACTS, good), other: (FACTS, good)}, "order_datetime", *FEBRUARY)
    assert content(spark, other) == [("new", 9.0, "2024-02-01")] and ("new", 9.0, "2024-02-01") in content(spark, path)


def test_a_rerun_with_rows_outside_the_range_changes_nothing(spark, path):
    rows = [("in", "2024-02-10T00:00:00Z", 9.0), ("near", "2024-03-20T00:00:00Z", 7.0), ("far", "2024-05-10T00:00:00Z", 8.0), ("none", None, 6.0)]
    span = ("2024-02-01T00:00:00+09:00", "2024-03-11T00:00:00+09:00")
    replace(spark, path, rows, span)
    once = content(spark, path)
    assert {r[0] for r in once} == {"jan", "in", "near", "late", "far", "none"}
    for _ in range(2):
        replace(spark, path, rows, span)
        assert content(spark, path) == once


def test_an_upsert_leaves_other_months_files(spark, path):
    before = files_of(path)
    source = facts(spark, [("feb", "2024-02-05T00:00:00Z", 20.0), ("new", "2024-03-05T00:00:00Z", 1.0)])
    tables.upsert(spark, path, FACTS, source, ["order_number"], "order_month", "order_datetime")
    assert content(spark, path) == sorted([("feb", 20.0, "2024-02-01"), ("new", 1.0, "2024-03-01")] + [r for r in START if r[0] != "feb"])
    assert before <= files_of(path)

    def of(month):
        return {f.rpartition("/")[2] for f in schemas.read_table(spark, path, FACTS, "order_month").where(f"order_month = date'{month}'").inputFiles()}

    old = {f.rpartition("/")[2] for f in before}
    assert of("2024-01-01") <= old and len(of("2024-03-01") & old) == 1 and len(of("2024-03-01") - old) == 1
    assert not of("2024-02-01") & old


def test_replaced_keys(spark, path):
    rows = facts(spark, [("feb", "2024-04-05T00:00:00Z", 20.0), ("feb", "2024-03-05T00:00:00Z", 21.0), ("new", "2024-03-05T00:00:00Z", 1.0)])
    numbers = rows.select("order_number").unionByName(spark.createDataFrame([("jan",)], "order_number string"))
    for _ in range(2):
        tables.replace_keys(spark, {path: (FACTS, rows)}, numbers, ["order_number"], "order_datetime")
        assert content(spark, path) == sorted([
            ("feb", 20.0, "2024-04-01"), ("feb", 21.0, "2024-03-01"), ("new", 1.0, "2024-03-01"), *[r for r in START if r[0] not in ("jan", "feb")],
        ])


def test_incoming_rows_are_computed_once(spark, path):
    """The input of a replacement is expensive: it is written first, and the months are taken from the folder."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = facts(spark, [("in", "2024-02-10T00:00:00Z", 9.0), ("stray", "2024-03-02T00:00:00Z", 8.0)])
    rows = rows.mapInArrow(counted, rows.schema)
    tables.replace_range(spark, path, FACTS, rows, "order_datetime", *FEBRUARY)
    assert seen.value == 2 and {"in", "stray", "mar", "late", "jan"} == {r[0] for r in content(spark, path)}


def test_a_range_of_one_product_reads_few_row_groups(spark, tmp_path):
    """Rows sorted by product within range-partitioned files let Parquet skip by statistics."""
    import pyarrow.parquet as pq

    path, schema = str(tmp_path / "ltv"), table(entry_manage_number=TEXT, month_offset=schemas.WHOLE)
    rows = spark.range(40_000).select(
        F.format_string("m%04d", F.col("id") % 2000).alias("entry_manage_number"), (F.col("id") % 20).alias("month_offset"),
        F.lit("2024-01-01").cast("date").alias("first_order_month"),
    )
    tables.replace_table(spark, rows, path, schema, "first_order_month", ["entry_manage_number", "month_offset"], cluster=4)
    files = [pq.ParquetFile(f) for f in files_of(path)]
    assert len(files) == 4
    stats = [f.metadata.row_group(g).column(0).statistics for f in files for g in range(f.num_row_groups)]
    assert sum(s.min <= "m0777" <= s.max for s in stats) == 1


def test_what_follows_from_a_row_is_not_shuffled(spark, path):
    """Rows are dealt out as they come; derived and absent columns, casts and checks come after the exchange."""
    plans = []
    wide = table(required={"order_number"}, order_number=TEXT, order_datetime=INSTANT, total_price=NUMBER, label=TEXT, absent=TEXT)
    house = path + "_wide"
    rows = spark.createDataFrame([("a", "2024-01-05T00:00:00Z", 2), ("b", "2024-02-05T00:00:00Z", 3)], "order_number string, order_datetime string, n int")
    rows = rows.withColumn("unused", F.lit("u"))
    derived = {"total_price": F.col("n") * 2, "label": F.concat(F.lit("long text "), "order_number")}
    counted = tabled._counted

    def seen(dealt):
        plans.append(dealt._jdf.queryExecution().optimizedPlan().toString())
        return counted(dealt)

    tabled._counted = seen
    try:
        for disposition in ("WRITE_APPEND", "WRITE_APPEND", "WRITE_TRUNCATE"):
            tables.load(spark, rows, house, wide, disposition, partition="order_month", ts_column="order_datetime", derived=derived)
    finally:
        tabled._counted = counted
    for plan in plans:
        assert plan.index("long text") < plan.index("Rebalance") and "absent" not in plan[plan.index("Rebalance"):] and "unused" not in plan
    got = sorted(map(tuple, schemas.read_table(spark, house, wide, "order_month").drop("order_datetime").collect()))
    assert got == [("a", 4.0, "long text a", None, date(2024, 1, 1)), ("b", 6.0, "long text b", None, date(2024, 2, 1))]
    with pytest.raises(Exception, match="order_number is null"):
        tables.load(spark, rows.withColumn("order_number", F.lit(None).cast("string")), house, wide, partition="order_month", ts_column="order_datetime")
    assert schemas.read_table(spark, house, wide, "order_month").count() == 2


def test_a_large_upsert_is_dealt_by_its_rows(spark, path, tmp_path, monkeypatch):
    """The join's partitions grow with the rows, and its result stays; a small source is left to Spark."""
    dealt, plans = [], []
    spread, settle = tables._spread, tables._settle
    monkeypatch.setattr(tables, "_spread", lambda frames, keys, pieces: dealt.append(pieces) or spread(frames, keys, pieces))
    monkeypatch.setattr(tables, "_settle", lambda spark, content, *a: plans.append(content._jdf.queryExecution().executedPlan().toString()) or settle(spark, content, *a))
    house = str(tmp_path / "large")
    start = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600)
    rows = spark.range(4000).select(F.col("id").cast("string").alias("order_number"), start.alias("order_datetime"), F.lit(1.0).alias("total_price"))
    tables.load(spark, rows, house, FACTS, partition="order_month", ts_column="order_datetime")
    source = rows.where("order_number % 3 = 0").unionByName(rows.withColumn("order_number", F.concat(F.lit("new-"), "order_number")))
    source = source.withColumn("total_price", F.lit(2.0))
    wanted = {(str(n), 2.0 if n % 3 == 0 else 1.0) for n in range(4000)} | {(f"new-{n}", 2.0) for n in range(4000)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for small, pieces in ((100_000, 0), (0, math.ceil((4000 + 4000 + 5334) / 500))):
            monkeypatch.setattr(tables, "ROWS_A_TASK", 500)
            monkeypatch.setattr(tables, "SMALL_SOURCE", small)
            assert tables.upsert(spark, house, FACTS, source, ["order_number"], "order_month", "order_datetime")
            assert dealt == [pieces, pieces]
            assert (f", {pieces})" in plans[0] or not pieces) and ("REPARTITION_BY_NUM" in plans[0]) == bool(pieces)
            found = [(r.order_number, r.total_price) for r in schemas.read_table(spark, house, FACTS, "order_month").collect()]
            assert len(found) == len(wanted) and set(found) == wanted
            dealt.clear()
            plans.clear()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_replaced_keys_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Staged keys look small by their compressed files; their number tells how they meet the tables, and the rows are the same."""
    from orderloom import session

    plans, hit = [], tables._hit

    def seen(target, source, keys, partition):
        for how in ("left_semi", "left_anti"):
            plans.append(target.join(source, keys, how)._jdf.queryExecution().sparkPlan().toString())
        return hit(target, source, keys, partition)

    monkeypatch.setattr(tables, "_hit", seen)
    start = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600)
    rows = spark.range(2000).select(F.col("id").cast("string").alias("order_number"), start.alias("order_datetime"), F.lit(1.0).alias("total_price"))
    for small, join in ((2000, "BroadcastHashJoin"), (1999, "SortMergeJoin")):
        monkeypatch.setattr(session, "SMALL_SIDE", small)
        house = str(tmp_path / join)
        tables.load(spark, rows, house, FACTS, partition="order_month", ts_column="order_datetime")
        changed = rows.where("order_number % 3 = 0").withColumn("total_price", F.lit(2.0))
        numbers = rows.where("order_number % 3 < 2").select("order_number")
        numbers = numbers.unionByName(numbers).unionByName(spark.range(666).select(F.concat(F.lit("none-"), "id").alias("order_number")))
        assert numbers.distinct().count() == 2000
        tables.replace_keys(spark, {house: (FACTS, changed)}, numbers, ["order_number"], "order_datetime")
        assert all(join in plan for plan in plans) and len(plans) == 2
        plans.clear()
        found = sorted((int(r.order_number), r.total_price) for r in schemas.read_table(spark, house, FACTS, "order_month").collect())
        assert found == [(n, 2.0 if n % 3 == 0 else 1.0) for n in range(2000) if n % 3 != 1]
