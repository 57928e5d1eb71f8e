from __future__ import annotations

import math

from pyspark.sql import functions as F

from souk.functions import dist
from souk.plans import stats
from souk.sources import warehouse

SF_SMOKE = "/root/testdata/sf0.001"


def norm_tail(z):
    return math.erfc(abs(z) / math.sqrt(2))


def t_tail(t, v):
    """Closed form for whole degrees of freedom."""
    a = math.atan(abs(t) / math.sqrt(v))
    term, total = (math.cos(a), math.cos(a)) if v % 2 else (1.0, 1.0)
    for k in range(3 if v % 2 else 2, v - 1, 2):
        term *= (k - 1) / k * math.cos(a) ** 2
        total += term
    if v % 2:
        return 1 - 2 / math.pi * (a + (math.sin(a) * total if v > 1 else 0))
    return 1 - math.sin(a) * total


def test_tails_against_closed_forms(spark):
    zs = [0.0, -0.3, 1.0, 1.959963984540054, 3.5, 8.0, 30.0]
    for r in spark.createDataFrame([(z,) for z in zs], "z double").select("z", dist.two_sided_norm(F.col("z")).alias("p")).collect():
        assert math.isclose(r.p, norm_tail(r.z), rel_tol=1e-11)
    rows = [(t, float(v)) for t in (0.1, -1.0, 2.228138851986274, 5.0) for v in (1, 2, 3, 5, 10, 31)]
    for r in spark.createDataFrame(rows, "t double, v double").select("t", "v", dist.two_sided_t(F.col("t"), F.col("v")).alias("p")).collect():
        assert math.isclose(r.p, t_tail(r.t, int(r.v)), rel_tol=1e-9)


def test_t_tail_nears_the_normal_tail(spark):
    # the first term of the difference is (t^3 + t) / (2 v) * density
    rows = [(t, v) for t in (1.0, 3.0) for v in (1e8, 1e10, 1e12)]
    for r in spark.createDataFrame(rows, "t double, v double").select("t", "v", dist.two_sided_t(F.col("t"), F.col("v")).alias("p")).collect():
        density = math.exp(-r.t * r.t / 2) / math.sqrt(2 * math.pi)
        assert math.isclose(r.p, norm_tail(r.t) + (r.t**3 + r.t) / (2 * r.v) * density, rel_tol=1e-11)


def test_tails_of_nothing(spark):
    r = spark.sql("SELECT CAST(NULL AS DOUBLE) z, 1.0D t, 0.0D v").select(
        dist.two_sided_norm(F.col("z")).alias("a"), dist.two_sided_t(F.col("t"), F.col("v")).alias("b"), dist.two_sided_t(F.col("z"), F.col("t")).alias("c")
    ).first()
    assert tuple(r) == (None, None, None)


def test_mann_whitney_equals_pair_counting(spark):
    wh = warehouse.from_driver(spark, SF_SMOKE)
    sample = stats.late_review_sample(wh).toPandas()
    late = sample.loc[sample.delivery_group == "late", "review_score"].to_numpy()
    ok = sample.loc[sample.delivery_group != "late", "review_score"].to_numpy()
    u_brute = sum(((x > ok).sum() + 0.5 * (x == ok).sum()) for x in late)
    row = stats.mann_whitney(wh).first()
    assert math.isclose(row.u_statistic, u_brute, rel_tol=1e-12)
    assert row.n_late + row.n_on_time == len(sample)
    rb = stats.rank_biserial(wh).first().rank_biserial
    assert math.isclose(rb, round(1 - 2 * u_brute / (len(late) * len(ok)), 6), abs_tol=1e-9)
    test = stats.mann_whitney_test(wh)
    assert 0.0 <= test["p_value"] <= 1.0
    z = stats._mann_whitney_row(wh).first().z
    assert math.isclose(test["p_value"], norm_tail(z), rel_tol=1e-11)


def test_welch_and_spearman_against_numpy(spark):
    wh = warehouse.from_driver(spark, SF_SMOKE)
    s = stats.late_review_sample(wh).toPandas()
    a = s.loc[s.delivery_group == "late", "review_score"].astype(float)
    b = s.loc[s.delivery_group != "late", "review_score"].astype(float)
    t = (a.mean() - b.mean()) / math.sqrt(a.var() / len(a) + b.var() / len(b))
    assert math.isclose(stats.welch_test(wh)["t_statistic"], t, rel_tol=1e-9)
    s2 = stats.installment_review_sample(wh).toPandas()
    rho = s2["installments"].rank().corr(s2["review_score"].rank())
    got = stats.spearman_test(wh)
    assert math.isclose(got["rho"], rho, abs_tol=1e-9)
    n = len(s2)
    t_rho = rho * math.sqrt((n - 2) / (1 - rho * rho))
    assert math.isclose(got["p_value"], t_tail(t_rho, n - 2), rel_tol=1e-6)
    w = stats.welch_test(wh)
    low, high = t_tail(w["t_statistic"], math.floor(w["df"])), t_tail(w["t_statistic"], math.ceil(w["df"]))
    assert min(low, high) <= w["p_value"] <= max(low, high)


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_purchase_month", "order_count", "total_revenue", "avg_order_value"]
    qs, orc = e.queries(), e.oracle_sql()
    assert set(orc) <= set(qs)
    # every query over the marketplace tables has its oracle
    from souk.catalog import all_oracles, all_queries

    assert set(all_oracles()) == set(all_queries())


def test_exact_u_counts_all_arrangements(spark):
    """Every U of small samples: the share of arrangements at least as far out, counted one by one."""
    from itertools import combinations

    from pyspark.sql import functions as F

    from souk.functions import dist

    rows, want = [], []
    for n1, n2 in ((1, 1), (1, 9), (2, 3), (4, 4), (7, 5), (3, 12)):
        us = [sum(c) - n1 * (n1 + 1) // 2 for c in combinations(range(1, n1 + n2 + 1), n1)]
        for u in range(n1 * n2 + 1):
            rows.append((float(n1), float(n2), float(u)))
            want.append(min(1.0, 2 * sum(x >= max(u, n1 * n2 - u) for x in us) / len(us)))
    df = spark.createDataFrame(rows, "n1 double, n2 double, u double")
    got = df.select(dist.two_sided_u(F.col("n1"), F.col("n2"), F.col("u")).alias("p")).collect()
    assert max(abs(r.p - w) for r, w in zip(got, want)) < 1e-12


def test_exact_p_only_for_small_samples_without_ties(spark):
    from souk.plans import stats

    def p(late, on_time):
        rows = [(stats.LATE, float(x)) for x in late] + [(stats.ON_TIME, float(x)) for x in on_time]
        return stats._with_p(stats.mann_whitney_of(spark.createDataFrame(rows, "delivery_group string, x double"), "x")).first().p_value

    assert abs(p([1, 2, 3], [4, 5, 6]) - 0.1) < 1e-12  # 2 of 20 arrangements
    assert p([1, 2, 3], [3, 5, 6]) != p([1, 2, 3], [4, 5, 6])  # ties: approximated
    assert p([], [1, 2]) is None
    many = p(range(0, 40, 2), range(1, 41, 2))
    assert 0.7 < many <= 1
