import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from floortally.operators import asof, code_lists, joins, shaping, temporal, totals

c = F.col
D = dt.date


@pytest.mark.parametrize("period", [asof.DAY, asof.WEEK, asof.MONTH, asof.WEEK_OR_MONTH])
def test_daily_history_equals_single_dates(spark, period):
    days = [D(2024, 2, 20) + dt.timedelta(n) for n in range(25)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    history = {(r.date, r.as_of) for r in asof.attach(df, asof.DAILY, period).collect()}
    for as_of in days:
        single = {r.date for r in asof.attach(df, as_of, period).collect()}
        assert single == {d for d, a in history if a == as_of}


def test_month_end_history_sees_each_day_once(spark):
    df = spark.createDataFrame([(D(2024, 2, 29),), (D(2024, 3, 1),), (D(2024, 3, 31),)], "date date")
    got = {(r.date, r.as_of) for r in asof.attach(df, asof.MONTH_END, asof.MONTH).collect()}
    assert got == {
        (D(2024, 2, 29), D(2024, 2, 29)),
        (D(2024, 3, 1), D(2024, 3, 31)),
        (D(2024, 3, 31), D(2024, 3, 31)),
    }


def test_validity(evaluate):
    day = D(2024, 1, 30)
    rows = [
        (day, None),
        (day, day),
        (D(2024, 1, 1), D(2024, 1, 29)),
        (D(2024, 1, 31), None),
        (D(2023, 1, 1), D(2099, 12, 31)),
    ]
    got = evaluate(
        rows,
        "f date, t date",
        temporal.valid_on(c("f"), c("t"), F.lit(day)),
        temporal.overlaps(c("f"), c("t"), F.lit(D(2024, 1, 1)), F.lit(day)),
        temporal.inside_clipped(F.lit(D(2024, 1, 15)), c("f"), c("t"), F.lit(D(2024, 1, 1)), F.lit(day)),
    )
    assert got == [(True, True, False), (True, True, False), (False, True, True), (False, False, False), (True, True, True)]


def test_top_k_breaks_ties_by_label(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 2), ("g", None, 2), ("g", "z", 5)], "g string, l string, n int")
    got = shaping.top_k(df, ["g"], "n", "l", 3).orderBy("rank").collect()
    assert [r.l for r in got] == ["z", "a", "b"]


def test_shares_sum_to_hundred_within_rounding(spark):
    rng = random.Random(3)
    rows = [(g, f"k{i}", rng.randint(1, 99)) for g in "ab" for i in range(9)]
    df = spark.createDataFrame(rows, "g string, k string, n int")
    got = shaping.share_of_total(df, ["g"], "n", "pct", 1).groupBy("g").agg(F.sum("pct").alias("s")).collect()
    assert all(abs(r.s - 100) <= 0.05 * 9 for r in got)


def test_heat(spark):
    df = spark.createDataFrame([("a", 10, 5), ("a", 20, 5), ("a", None, 5)], "g string, v int, flat int")
    got = shaping.min_max_heat(df, ["g"], ["v", "flat"]).orderBy(F.asc_nulls_last("v")).collect()
    assert [(r.v_heat, r.flat_heat) for r in got] == [(0.0, 1.0), (1.0, 1.0), (None, 1.0)]


def test_sort_orders(spark):
    df = spark.createDataFrame([(1, False), (None, False), (9, True), (5, False)], "v int, total boolean")
    up = df.orderBy(*shaping.nulls_last(["v"])).collect()
    down = df.orderBy(*shaping.nulls_last(["v"], ascending=False)).collect()
    assert [r.v for r in up] == [1, 5, 9, None] and [r.v for r in down] == [9, 5, 1, None]
    for ascending, expected in ((False, [5, 1, None, 9]), (True, [1, 5, None, 9])):
        assert [r.v for r in df.orderBy(*shaping.pinned_order("total", "v", ascending)).collect()] == expected


def test_code_counts_of_a_hot_group_lie_in_no_single_partition(spark):
    hot = spark.range(36_000).selectExpr("1 as day", "'hot' as g", "concat('c', id % 9000) as code", "2 as w")
    cold = spark.range(4_000).selectExpr("1 as day", "concat('g', id % 7) as g", "concat('d', id) as code", "1 as w")
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        got = code_lists.code_counts(hot.union(cold), ["day", "g"], "code", c("w"))
        sizes = got.where("g = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set(name, "true")
    assert sum(r["count"] for r in sizes) == 9000 and max(r["count"] for r in sizes) < 9000 / 2
    assert got.where("g = 'hot'").agg(F.min("n"), F.max("n")).first() == (8, 8)
    assert got.agg(F.sum("n")).first()[0] == 2 * 36_000 + 4_000


def test_code_counts_leave_out_missing_codes(spark):
    rows = [("g", " a ", 2), ("g", "a", 3), ("g", "", 4), ("g", None, 5), ("h", None, 1), (None, "b", 1)]
    df = spark.createDataFrame(rows, "g string, code string, w int")
    got = code_lists.code_counts(df, ["g"], "code").collect()
    assert {tuple(r) for r in got} == {("g", "a", 2), (None, "b", 1)}
    assert {tuple(r) for r in code_lists.code_counts(df, ["g"], "code", c("w")).collect()} == {("g", "a", 5), (None, "b", 1)}
    assert code_lists.code_counts(df.limit(0), ["g"], "code").count() == 0


def test_code_lists_hold_every_code_of_a_large_group_in_one_row(spark):
    large = spark.range(5_000).selectExpr("'g' as g", "concat(' c', lpad(id, 5, '0')) as code", "cast(1 + id % 2 as bigint) as n")
    odd = spark.createDataFrame([("g", "", 3), ("g", None, 4), ("h", " ", 1), ("i", "x", 0)], "g string, code string, n bigint")
    rows = large.union(odd).select("g", code_lists.listed("code").alias("code"), "n")
    cells = [code_lists.code_list("code", "n"), code_lists.code_list("code", "n", distinct=True)]
    got = {r[0]: (r[1], r[2]) for r in rows.groupBy("g").agg(*cells).collect()}
    codes = [f"c{i:05}" for i in range(5_000)]
    every = [code for i, code in enumerate(codes) for _ in range(1 + i % 2)]
    assert got == {"g": (", ".join(every), ", ".join(codes)), "h": ("", ""), "i": ("", "")}


def test_split_left_join_is_a_left_join(spark):
    rng = random.Random(5)
    left = spark.createDataFrame([(rng.randint(0, 6), n) for n in range(12)], "k int, v int")
    right = spark.createDataFrame([(rng.choice([1, 1, 1, 2, 9]), n) for n in range(40)], "k int, w int")
    inside = c("r.w") >= c("l.v") * 4
    got = joins.split_left_join(left, right, ["k"], inside).select("k", "v", "w").collect()
    l, r = left.alias("l"), right.alias("r")
    expected = l.join(r, (c("l.k") == c("r.k")) & inside, "left").select("l.k", "l.v", "r.w").collect()
    order = lambda rows: sorted((tuple(x) for x in rows), key=str)
    assert order(got) == order(expected)


def test_null_safe_merge_is_optional(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "r string, w int")
    safe = joins.left_on(left, right, "k", "r", null_safe=True).orderBy("v").collect()
    plain = joins.left_on(left, right, "k", "r").orderBy("v").collect()
    assert [r.w for r in safe] == [10, 20] and [r.w for r in plain] == [None, 20]
    assert safe[0].asDict().keys() == {"k", "v", "w"}


def test_grand_total_uses_unweighted_means(spark):
    df = spark.createDataFrame([("r", "a", 10, 50.0), ("r", "b", 1, 51.0), ("r", "c", 5, None)], "r string, m string, n int, p double")
    got = {x.m: x for x in totals.with_total(df, ["r"], "m", ["n"], ["p"]).collect()}
    assert (got["Grand Total"].n, got["Grand Total"].p, got["Grand Total"].is_total) == (16, 50.0, True)
    assert (got["b"].n, got["b"].p, got["b"].is_total) == (1, 51.0, False)
    assert got["c"].p is None and len(got) == 4


def test_mean_of_rounded_ignores_order_and_nulls(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.3,)], "v double")
    assert df.agg(totals.mean_of_rounded(c("v"))).first()[0] == 0.2
    assert df.where("v is null").agg(totals.mean_of_rounded(c("v"))).first()[0] is None


def test_append_fills_missing_columns(spark):
    upper = spark.createDataFrame([(1, 2)], "a int, b int")
    lower = spark.createDataFrame([(3, 4)], "a int, c int")
    assert {tuple(r) for r in shaping.append(upper, lower).collect()} == {(1, 2, None), (3, None, 4)}


def test_positions_keep_the_order_of_a_written_table(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), k) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(7)
    placed = shaping.positioned(df, ["g"], [F.desc("v"), F.asc("k")])
    placed.repartition(5).write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t")).orderBy(F.asc_nulls_last("g"), "position").collect()
    assert [tuple(r)[:3] for r in back] == sorted(rows, key=lambda r: (r[0] is None, r[0] or "", -r[1], r[2]))
    assert [tuple(r) for r in placed.collect()] == [tuple(r) for r in back]
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
