"""First purchases and cohorts on small hand-made tables, against plain Python where it pays."""

import random
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderloom.operators import cohort_ltv, first_purchase as fp
from orderloom.operators.product_master import best_names

ORDER = "order_number string, user_email string, t string, order_status string, total_price double"
ITEM = "order_number string, manage_number string, item_name string, subtotal double"
MASTER = "manage_number string, product_name string, category_name string, brand_name string"


def orders_of(spark, rows):
    df = spark.createDataFrame(rows, ORDER)
    return df.withColumn("order_datetime", F.col("t").cast("timestamp")).drop("t")


def items_of(spark, rows):
    return spark.createDataFrame(rows, ITEM)


def names_of(spark, rows):
    return best_names(spark.createDataFrame(rows, MASTER))


def test_statuses(spark):
    orders = orders_of(spark, [
        ("1", "u", "2024-01-01T00:00:00Z", "900", 1.0), ("2", "u", "2024-01-02T00:00:00Z", None, 1.0),
        ("3", "u", "2024-01-03T00:00:00Z", "800", 1.0), ("4", "u", "2024-01-04T00:00:00Z", "300", 1.0),
    ])
    assert sorted(r.order_number for r in fp.base_orders(orders).collect()) == ["3", "4"]
    assert sorted(r.order_number for r in fp.base_orders(orders, ("900", "800")).collect()) == ["4"]


def test_first_order_ties_and_users_without_name(spark):
    orders = orders_of(spark, [
        ("10", "u", "2024-01-31T15:00:00Z", "300", 1.0), ("09", "u", "2024-01-31T15:00:00Z", "300", 1.0),
        ("01", "u", "2024-02-10T00:00:00Z", "300", 1.0), ("02", None, "2020-01-01T00:00:00Z", "300", 1.0),
    ])
    assert [tuple(r) for r in fp.first_orders(orders).collect()] == [("u", "09", date(2024, 2, 1), date(2024, 2, 1))]


def test_entry_product_order(spark):
    items = items_of(spark, [
        ("a", None, "no key", 999.0), ("a", "m9", "x", 5.0), ("a", "m2", "z", 5.0), ("a", "m2", "y", 5.0), ("a", "m1", "x", None),
        ("b", "m5", "x", None), ("b", "m4", None, None), ("c", None, "x", 1.0), ("d", "m1", "x", -9999.0), ("d", "m2", "x", None),
    ])
    assert sorted(map(tuple, fp.entry_items(items).collect())) == [("a", "m2", "y"), ("b", "m4", None), ("d", "m1", "x")]


def test_names_fall_back_to_the_item(spark):
    orders = orders_of(spark, [(n, n, "2024-01-05T00:00:00Z", "300", 1.0) for n in "abc"])
    items = items_of(spark, [("a", "m1", "item a", 1.0), ("b", "m2", "item b", 1.0), ("c", None, "item c", 1.0)])
    names = names_of(spark, [("m1", "Master", "cat", "br"), ("m2", "", "cat2", None)])
    first = fp.entry_products(fp.first_orders(orders), items, names)
    got = sorted((r.user_email, r.entry_item_name, r.category_name, r.brand_name) for r in first.collect())
    assert got == [("a", "Master", "cat", "br"), ("b", "item b", "cat2", None)]
    assert fp.first_purchases(orders, items, names).columns == fp.FIRST_PURCHASE_COLUMNS


def test_items_of_later_orders_are_not_shuffled(spark, monkeypatch):
    """A user's first order is one of a hundred here; also with so few marks that all are set, the result is the same."""
    orders = spark.range(2000).select(
        F.col("id").cast("string").alias("order_number"), (F.col("id") % 20).cast("string").alias("user_email"),
        F.timestamp_seconds(F.col("id") * 60).alias("order_datetime"), F.lit("300").alias("order_status"), F.lit(1.0).alias("total_price"),
    )
    items = spark.range(6000).select(
        (F.col("id") % 2000).cast("string").alias("order_number"), F.concat(F.lit("m"), "id").alias("manage_number"),
        F.lit("x").alias("item_name"), F.col("id").cast("double").alias("subtotal"),
    ).unionByName(items_of(spark, [(None, "m", "x", 1.0)]))
    names = names_of(spark, [("m4000", "Master", None, None)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for marks in (fp.MARKS, 64):
            monkeypatch.setattr(fp, "MARKS", marks)
            first = fp.entry_products(fp.first_orders(orders), items, names)
            plan = first._jdf.queryExecution().optimizedPlan().toString()
            assert "LeftSemi" not in plan and plan.index("Aggregate [order_number") < plan.index("getbit(")  # looked up below the shuffle
            assert sorted((int(r.user_email), r.entry_manage_number) for r in first.collect()) == [(n, f"m{4000 + n}") for n in range(20)]
        monkeypatch.undo()
        numbers = fp.first_orders(orders).select(F.col("first_order_number").alias("order_number"))
        assert 60 <= fp._marked_items(items, numbers).count() < 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_merge_takes_new_users_of_the_month_once(spark):
    orders = orders_of(spark, [
        ("1", "old", "2024-01-05T00:00:00Z", "300", 1.0), ("2", "old", "2024-02-05T00:00:00Z", "300", 1.0),
        ("3", "new", "2024-02-06T00:00:00Z", "300", 1.0), ("4", "next", "2024-02-29T15:00:00Z", "300", 1.0),
        ("5", "known", "2024-02-07T00:00:00Z", "300", 1.0),
    ])
    items = items_of(spark, [(str(i), "m", "x", 1.0) for i in range(1, 6)])
    names = names_of(spark, [("m", "M", None, None)])
    known = spark.createDataFrame([("known",)], "user_email string")
    added = fp.new_first_purchases(orders, items, names, known, "2024-02-01")
    assert [(r.user_email, r.first_order_number) for r in added.collect()] == [("new", "3")]
    again = fp.new_first_purchases(orders, items, names, known.union(added.select("user_email")), "2024-02-01")
    assert again.count() == 0


def plain_ltv(first, sales, names):
    """The cohort table by loops over users, joins repeated as the definition has them."""
    sizes = defaultdict(set)
    for user, product, name, month in first:
        label = (names.get(product, (None,))[0] or name, *(names.get(product, (None, None, None))[1:]))
        sizes[product, label, month].add(user)
    groups = defaultdict(lambda: [set(), 0])
    for user, product, name, month in first:
        label = (names.get(product, (None,))[0] or name, *(names.get(product, (None, None, None))[1:]))
        for (who, sold), amount in sales.items():
            offset = sold - month
            if who != user or offset < 0:
                continue
            for (p, _, m), users in sizes.items():
                if (p, m) == (product, month):
                    group = groups[product, label, month, offset, len(users)]
                    group[0].add(user)
                    group[1] += amount
    out = []
    for (product, label, month, offset, size), (buyers, revenue) in groups.items():
        if not (buyers or revenue > 0):
            continue
        running = sum(
            g[1] for (p, _, m, o, _), g in groups.items() if (p, m) == (product, month) and o <= offset
        )
        out.append((product, *label, month, offset, size, len(buyers), revenue, running))
    return sorted(out, key=str)


def ltv_case(spark, seed, duplicated):
    rng = random.Random(seed)
    users = [f"u{i}" for i in range(30)]
    products = ["p1", "p2", "p3"]  # p3 is in no master: its names differ from user to user
    names = {"p1": ("One", "c1", None), "p2": (None, "c2", "b2")}
    first = [(u, rng.choice(products), rng.choice("xyz"), rng.randrange(3)) for u in users]
    if duplicated:
        first += rng.sample(first, 8)
        first += [(u, p, rng.choice("xyz"), m) for u, p, _, m in rng.sample(first, 8)]
        first += [(u, rng.choice(products), n, rng.randrange(3)) for u, _, n, _ in rng.sample(first, 8)]
    orders = [(f"{i}", rng.choice([*users, "stranger"]), rng.randrange(6), rng.choice(["300", "900", "800"]), float(rng.randrange(-3, 500))) for i in range(300)]
    sales = defaultdict(int)
    for _, user, month, status, amount in orders:
        if status != "900":
            sales[user, month] += amount
    month_day = lambda m: date(2024, 1 + m, 1)
    first_df = spark.createDataFrame(
        [(u, p, n, month_day(m)) for u, p, n, m in first], "user_email string, entry_manage_number string, entry_item_name string, first_order_month date"
    )
    orders_df = orders_of(spark, [(n, u, f"{month_day(m)}T05:00:00Z", s, a) for n, u, m, s, a in orders])
    names_df = spark.createDataFrame([(k, *v) for k, v in names.items()], MASTER)
    return first, sales, names, first_df, orders_df, names_df


@pytest.mark.parametrize("seed, duplicated", [(1, False), (2, False), (3, True)])
def test_ltv_equals_plain_loops(spark, seed, duplicated):
    first, sales, names, first_df, orders_df, names_df = ltv_case(spark, seed, duplicated)
    rows = cohort_ltv.ltv_by_month_offset(first_df, orders_df, names_df).collect()
    got = sorted(
        ((r.entry_manage_number, r.entry_item_name, r.category_name, r.brand_name, r.first_order_month.month - 1, r.month_offset,
          r.cohort_users, r.active_buyers, r.revenue_in_month, r.cumulative_revenue) for r in rows), key=str
    )
    assert got == plain_ltv(first, sales, names)
    for r in rows:
        assert r.ltv_per_user == r.cumulative_revenue / r.cohort_users
        assert r.aov_in_month == r.revenue_in_month / r.active_buyers


def test_canonical_table_counts_every_sale_once(spark):
    _, _, _, first_df, orders_df, names_df = ltv_case(spark, 7, False)
    rows = cohort_ltv.ltv_canonical(first_df, orders_df, names_df)
    keys = rows.select("entry_manage_number", "first_order_month", "month_offset")
    assert keys.count() == keys.distinct().count()
    sold = cohort_ltv.user_cohort_sales(first_df, orders_df, names_df).agg(F.sum("monthly_sales")).first()[0]
    assert rows.agg(F.sum("revenue_in_month")).first()[0] == sold


def test_running_revenue_never_falls_without_refunds(spark):
    _, _, _, first_df, orders_df, names_df = ltv_case(spark, 5, False)
    rows = cohort_ltv.ltv_canonical(first_df, orders_df.where("total_price >= 0"), names_df).collect()
    seen = defaultdict(list)
    for r in rows:
        seen[r.entry_manage_number, r.first_order_month].append((r.month_offset, r.cumulative_revenue))
    for series in seen.values():
        values = [v for _, v in sorted(series)]
        assert values == sorted(values)


def test_name_refresh(spark):
    ltv = spark.createDataFrame(
        [
            ("same", "A", "c", "b"), ("renamed", "old", "c", "b"), ("recategorised", "A", "old", "b"), ("to_blank", "A", "", None),
            ("null_old", None, "c", "b"), ("null_new", "A", "old", "b"), ("null_new_same", "A", "c", "b"), ("unsold", "old", "c", "b"), ("unmastered", "old", "c", "b"),
        ],
        "entry_manage_number string, entry_item_name string, category_name string, brand_name string",
    )
    names = names_of(spark, [
        ("same", "A", "c", "b"), ("renamed", "A", "c", "b"), ("recategorised", "A", "c", "b"), ("to_blank", "A", None, None),
        ("null_old", "A", "c", "b"), ("null_new", None, "c", "b"), ("null_new_same", None, "c", "b"), ("unsold", "A", "c", "b"),
    ])
    sold = ["same", "renamed", "recategorised", "to_blank", "null_old", "null_new", "null_new_same", "unmastered"]
    items = items_of(spark, [("o", m, "x", 1.0) for m in sold] + [("o2", "renamed", "y", 1.0)])
    got = {r.entry_manage_number: tuple(r)[1:] for r in cohort_ltv.refreshed_names(ltv, items, names).collect()}
    assert got == {
        "same": ("A", "c", "b", False), "renamed": ("A", "c", "b", True), "recategorised": ("A", "c", "b", True),
        "to_blank": ("A", "", None, False), "null_old": (None, "c", "b", False), "null_new": (None, "c", "b", True),
        "null_new_same": ("A", "c", "b", False), "unsold": ("old", "c", "b", False), "unmastered": ("old", "c", "b", False),
    }
