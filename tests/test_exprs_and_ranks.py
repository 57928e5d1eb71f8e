from __future__ import annotations

import random
from datetime import datetime as dt

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from souk.functions.exprs import day_diff, floor_days, money, money_avg, money_value, month_diff, r2, strip, year_month
from souk.operators.ranks import _numbered, average_ranks, ntile_many


def test_floor_days_sub_day_deltas(spark):
    rows = [
        (dt(2018, 1, 10, 11), dt(2018, 1, 10, 10)),  # 1 h early -> -1
        (dt(2018, 1, 20, 11), dt(2018, 1, 21, 10)),  # 23 h late -> 0
        (dt(2018, 2, 4, 11), dt(2018, 2, 5, 12)),  # 25 h late -> 1
        (dt(2018, 3, 5), dt(2018, 3, 1)),  # 4 days early -> -4
        (None, dt(2018, 3, 1)),
        (dt(2018, 3, 1), None),
    ]
    df = spark.createDataFrame(rows, "est timestamp_ntz, dlv timestamp_ntz")
    got = [r.d for r in df.select(floor_days("est", "dlv").alias("d")).collect()]
    assert got == [-1, 0, 1, -4, None, None]


def test_month_and_day_boundaries(spark):
    df = spark.createDataFrame(
        [(dt(2017, 12, 31, 23), dt(2018, 1, 1, 1)), (dt(2018, 1, 1), dt(2018, 1, 31, 23))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = df.select(month_diff("a", "b").alias("m"), day_diff("a", "b").alias("d"), year_month("a").alias("ym"))
    assert [tuple(r) for r in got.collect()] == [(1, 1, "2017-12"), (0, 30, "2018-01")]


def test_r2_matches_duckdb_round(spark):
    rnd = random.Random(7)
    vals = [round(rnd.uniform(-1000, 1000), 3) for _ in range(2000)] + [0.125, 2.675, 1.005, -0.125, 50.005]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.y for r in df.select(r2("x").alias("y")).collect()]
    con = duckdb.connect()
    con.register("t", pd.DataFrame({"x": vals}))
    want = [r[0] for r in con.execute("SELECT ROUND(x, 2) FROM t").fetchall()]
    assert got == want


def test_strip_unicode_whitespace(spark):
    df = spark.createDataFrame([("\t a b  ",), ("   ",), (None,), ("x",)], "s string")
    got = [r.s for r in df.select(strip("s").alias("s")).collect()]
    assert got == ["a b", "", None, "x"]


def _ntile_brute(values, ids, k, asc=True):
    order = sorted(range(len(values)), key=lambda i: ((values[i] if asc else -values[i]), ids[i]))
    n = len(values)
    q, m = divmod(n, k)
    out = {}
    for rank, i in enumerate(order, start=1):
        if rank <= m * (q + 1):
            out[ids[i]] = (rank - 1) // (q + 1) + 1
        else:
            out[ids[i]] = (rank - 1 - m) // q + 1
    return out


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.integers(min_value=0, max_value=4), min_size=1, max_size=60),
    st.integers(min_value=1, max_value=7),
)
def test_ntile_many_equals_sql_ntile(spark, values, k):
    ids = [f"id{i:03d}" for i in range(len(values))]
    df = spark.createDataFrame(list(zip(ids, values, [v * 10 for v in values])), "id string, a long, b long")
    got = ntile_many(df, "id", {"asc": ("a", True), "desc": ("b", False)}, k=k, num_partitions=3).collect()
    want_a = _ntile_brute(values, ids, k, True)
    want_b = _ntile_brute([v * 10 for v in values], ids, k, False)
    assert {r.id: r.asc for r in got} == want_a
    assert {r.id: r.desc for r in got} == want_b
    assert {r.id: r.a for r in got} == dict(zip(ids, values))  # other columns ride along


def test_ntile_sizes_differ_by_at_most_one(spark):
    df = spark.range(0, 1003).select(F.format_string("c%05d", "id").alias("id"), (F.col("id") % 3).alias("v"))
    got = ntile_many(df, "id", {"s": ("v", True)}, k=5, num_partitions=7)
    sizes = [r["count"] for r in got.groupBy("s").count().collect()]
    assert sorted(sizes) == [200, 200, 201, 201, 201]


def test_average_ranks_match_pandas(spark):
    vals = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    got = {r.v: r.avg_rank for r in average_ranks(df, "v").collect()}
    ranks = pd.Series(vals).rank(method="average")
    want = dict(zip(vals, ranks))
    assert got == want


def test_wide_column_is_ranked_in_many_tasks(spark):
    """A million distinct values, a third of all rows at one of them: prefix sums over ranges, no window over all values."""
    n = 1_000_000
    df = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7.0).alias("v"))
    df = df.unionByName(spark.range(n // 2).select(F.lit(12.5).alias("v"))).unionByName(spark.createDataFrame([(None,)], "v double"))
    hist = df.where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    sizes = [r["count"] for r in _numbered(hist, ["v"], 8).groupBy("_pid").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * n / 8
    got = average_ranks(df, "v", num_partitions=8).toPandas().sort_values("v", ignore_index=True)
    s = df.toPandas().v.dropna()
    want = s.rank(method="average").groupby(s).first()
    assert got.v.tolist() == want.index.tolist() and got.avg_rank.tolist() == want.tolist()
    assert got.n.sum() == len(s) and got.rank_before.tolist() == [0, *got.n.cumsum()[:-1]]
    few = spark.createDataFrame([(float(x % 7),) for x in range(50)], "v double")
    assert sorted(average_ranks(few, "v").collect()) == sorted(average_ranks(few, "v", closed=True).collect())
    assert average_ranks(few.limit(0), "v").count() == 0


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.text(alphabet=st.sampled_from(list("ab é\t\n\r\x0b\x0c\xa0 　﻿\x1c")), max_size=8),
        min_size=1,
        max_size=30,
    )
)
def test_strip_equals_python_strip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.s for r in df.select(strip("s").alias("s")).collect()]
    assert got == [t.strip() for t in texts]


def test_ntile_null_keys_follow_sql_order(spark):
    # ascending: NULLs first; descending: NULLs last (Spark and SQL defaults)
    rows = [("a", None), ("b", 1), ("c", 2), ("d", None), ("e", 3)]
    df = spark.createDataFrame(rows, "id string, v long")
    got = {r.id: (r.up, r.down) for r in ntile_many(df, "id", {"up": ("v", True), "down": ("v", False)}, k=5).collect()}
    assert [got[i][0] for i in "adbce"] == [1, 2, 3, 4, 5]
    assert [got[i][1] for i in "ecbad"] == [1, 2, 3, 4, 5]
    want = spark.createDataFrame(rows, "id string, v long").selectExpr(
        "id", "ntile(5) OVER (ORDER BY v ASC, id) AS up", "ntile(5) OVER (ORDER BY v DESC, id) AS down"
    )
    assert {r.id: (r.up, r.down) for r in want.collect()} == got


def test_average_ranks_across_many_partitions(spark):
    rnd = random.Random(11)
    vals = [rnd.randint(0, 199) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    got = {r.v: (r.n, r.avg_rank) for r in average_ranks(df, "v").collect()}
    s = pd.Series(vals)
    ranks = s.rank(method="average")
    want = {v: (int((s == v).sum()), float(ranks[s == v].iloc[0])) for v in set(vals)}
    assert got == want


def test_wall_clock_results_do_not_depend_on_the_session_zone(spark):
    from souk.functions.exprs import month_trunc

    rows = [
        (dt(2016, 10, 16, 0, 30), dt(2016, 10, 15, 23, 30)),  # around a DST change in Sao Paulo
        (dt(2017, 2, 18, 23, 30), dt(2017, 2, 19, 0, 30)),
        (dt(2017, 12, 31, 23, 59), dt(2018, 1, 1, 0, 1)),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    exprs = [
        floor_days("a", "b").alias("d"),
        year_month("a").alias("ym"),
        month_trunc("b").cast("string").alias("mt"),
        month_diff("a", "b").alias("md"),
        day_diff("a", "b").alias("dd"),
    ]
    utc = [tuple(r) for r in df.select(*exprs).collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        local = [tuple(r) for r in df.select(*exprs).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert local == utc


def test_money_averages_are_exact_for_large_sums(spark):
    n = 884_567_286_526
    df = spark.sql(f"SELECT CAST(1959498 AS DECIMAL(20,0)) * {n} / 100 AS t, {n}L AS n, 0L AS none")
    row = df.select(money_avg("t", "n").alias("a"), money_avg(-df["t"], "n").alias("b"), money_avg("t", "none").alias("c")).first()
    assert (row.a, row.b, row.c) == (19594.98, -19594.98, None)


def test_money_keeps_what_is_below_a_cent(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (0.002,), (1.005,)], "v double")
    row = df.agg(F.sum(money("v")).alias("t"), F.count("v").alias("n")).select(money_value("t").alias("t"), money_avg("t", "n").alias("a")).first()
    assert (row.t, row.a) == (1.02, 0.25)  # 1.015 rounds half up, 0.25375 down
