"""Rank-based statistics on Spark.

The two samples are built with joins; ranking works on value histograms
(``histogram_ranks``), so pairing and counting run distributed and each test
statistic ends as arithmetic on a one-row aggregate.  The tail probabilities
(``souk.functions.dist``) are column expressions on that one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions import dist
from souk.functions.exprs import r2, safe_div
from souk.operators.ranks import average_ranks, histogram_ranks
from souk.plans.base import Warehouse, delay_status

LATE, ON_TIME = "late", "on_time_or_early"
DIGITS = 6
MAX_INSTALLMENTS_SHOWN = 18

# Effect-size labels by |r| (upper bounds, checked in order).
EFFECT_THRESHOLDS = [(0.11, "negligible"), (0.28, "small"), (0.43, "medium")]
LARGEST_EFFECT = "large"


def r6(c):
    return r2(c, DIGITS)


# -- sample 1: delivery timing vs review score -------------------------------


def late_review_sample(wh: Warehouse) -> DataFrame:
    """One row per review of an order with a known delay (any status)."""
    o = wh["orders"].where(F.col("delivery_delay_days").isNotNull()).select("order_id", "delivery_delay_days")
    return o.join(wh["order_reviews"].select("order_id", "review_score"), "order_id").select(
        "order_id",
        "delivery_delay_days",
        delay_status(late=LATE, other=ON_TIME).alias("delivery_group"),
        "review_score",
    )


def group_descriptives(wh: Warehouse) -> DataFrame:
    """N, mean, median, sample std of the score per delivery group."""
    return (
        late_review_sample(wh)
        .groupBy("delivery_group")
        .agg(
            F.count(F.lit(1)).alias("n"),
            r6(F.avg("review_score")).alias("mean"),
            r6(F.median("review_score")).alias("median"),
            r6(F.stddev_samp("review_score")).alias("std"),
        )
        .orderBy("delivery_group")
    )


def score_histogram(wh: Warehouse) -> DataFrame:
    """Reviews per unit score bin (0.5..5.5) and group."""
    return (
        late_review_sample(wh)
        .groupBy("delivery_group", F.floor(F.col("review_score") + F.lit(0.5)).cast("long").alias("score_bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("delivery_group", "score_bin")
    )


def review_score_ranks(wh: Warehouse) -> DataFrame:
    """Average rank of each review score within sample 1."""
    return average_ranks(late_review_sample(wh), "review_score", closed=True).orderBy("review_score")


def _mann_whitney_row(wh: Warehouse) -> DataFrame:
    """(n_late, n_on_time, u_statistic, tie_term, z) of the review scores: U of the late group, two-sided z."""
    return mann_whitney_of(late_review_sample(wh), "review_score", closed=True)


def mann_whitney_of(sample: DataFrame, value: str, closed: bool = False) -> DataFrame:
    """(n_late, n_on_time, u_statistic, tie_term, z) of a column of a sample with delivery_group.

    One pass over the sample makes the histogram of values with the late rows
    of each; everything else happens on that (closed: see ``histogram_ranks``).
    """
    hist = (
        sample.where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("delivery_group") == LATE).alias("n_late_v"))
    )
    a = histogram_ranks(hist, value, closed).agg(
        F.sum("n_late_v").cast("double").alias("n1"),
        (F.sum("n") - F.sum("n_late_v")).cast("double").alias("n2"),
        F.sum(F.col("n_late_v") * F.col("avg_rank")).alias("r1"),
        F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("tie_term"),
    )
    n1, n2 = F.col("n1"), F.col("n2")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    nn = n1 + n2
    sd = F.sqrt(n1 * n2 / 12 * ((nn + 1) - F.col("tie_term") / (nn * (nn - 1))))
    u_big = F.greatest(u1, n1 * n2 - u1)
    return a.select(
        n1.cast("long").alias("n_late"),
        n2.cast("long").alias("n_on_time"),
        u1.alias("u_statistic"),
        F.col("tie_term"),
        safe_div(u_big - n1 * n2 / 2 - 0.5, sd).alias("z"),
    )


def mann_whitney(wh: Warehouse) -> DataFrame:
    """Mann-Whitney U of the late group against on-time/early (normal approximation terms)."""
    return _mann_whitney_row(wh).select(
        "n_late", "n_on_time", r6("u_statistic").alias("u_statistic"), r6("tie_term").alias("tie_term"),
        r6("z").alias("z"),
    )


def _welch_row(wh: Warehouse) -> DataFrame:
    g = late_review_sample(wh).agg(
        *[
            x
            for grp, tag in ((LATE, "1"), (ON_TIME, "2"))
            for x in (
                F.count_if(F.col("delivery_group") == grp).cast("double").alias("n" + tag),
                F.avg(F.when(F.col("delivery_group") == grp, F.col("review_score"))).alias("m" + tag),
                F.var_samp(F.when(F.col("delivery_group") == grp, F.col("review_score"))).alias("v" + tag),
            )
        ]
    )
    a, b = safe_div("v1", "n1"), safe_div("v2", "n2")
    t = safe_div(F.col("m1") - F.col("m2"), F.sqrt(a + b))
    df = safe_div((a + b) * (a + b), safe_div(a * a, F.col("n1") - 1) + safe_div(b * b, F.col("n2") - 1))
    return g.select(t.alias("t_statistic"), df.alias("df"))


def welch_t(wh: Warehouse) -> DataFrame:
    """T4: Welch's t of late minus on-time means, Welch–Satterthwaite df."""
    return _welch_row(wh).select(r6("t_statistic").alias("t_statistic"), r6("df").alias("df"))


def _effect_label(r):
    expr = None
    for bound, label in EFFECT_THRESHOLDS:
        cond = F.abs(r) < bound
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(LARGEST_EFFECT))


def _rank_biserial_row(wh: Warehouse) -> DataFrame:
    r = F.lit(1.0) - 2 * safe_div("u_statistic", F.col("n_late") * F.col("n_on_time"))
    return _mann_whitney_row(wh).select("n_late", "n_on_time", "u_statistic", r.alias("rank_biserial"))


def rank_biserial(wh: Warehouse) -> DataFrame:
    """T5: r = 1 - 2U/(n1 n2), U of the late group."""
    return _rank_biserial_row(wh).select(
        "n_late", "n_on_time", r6("u_statistic").alias("u_statistic"), r6("rank_biserial").alias("rank_biserial")
    )


def effect_size(wh: Warehouse) -> DataFrame:
    """Rank-biserial r with the magnitude label of its unrounded value."""
    return _rank_biserial_row(wh).select(
        r6("rank_biserial").alias("rank_biserial"), _effect_label(F.col("rank_biserial")).alias("effect_size")
    )


# -- sample 2: instalments vs review score -----------------------------------


def installment_review_sample(wh: Warehouse) -> DataFrame:
    """Per (order, review score), the largest instalment count of its payments (> 0)."""
    p = wh["order_payments"].where(F.col("payment_installments") > 0).groupBy("order_id").agg(
        F.max("payment_installments").alias("installments")
    )
    r = wh["order_reviews"].select("order_id", "review_score").distinct()
    return p.join(r, "order_id").select("order_id", "installments", "review_score")


def installment_review_describe(wh: Warehouse) -> DataFrame:
    """Count, mean, std, min, quartiles (exact, linear interpolation) and max of both columns, in one pass."""
    names = ("installments", "review_score")

    def described(c: str) -> Column:
        x, quarter = F.col(c), F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        figures = {
            "count": F.count(x), "mean": r6(F.avg(x)), "std": r6(F.stddev_samp(x)), "min": F.min(x).cast("double"),
            "p25": r6(F.get(quarter, F.lit(0))), "p50": r6(F.get(quarter, F.lit(1))), "p75": r6(F.get(quarter, F.lit(2))),
            "max": F.max(x).cast("double"),
        }
        return F.struct(F.lit(c).alias("variable"), *(v.alias(k) for k, v in figures.items()))

    one = installment_review_sample(wh).agg(F.array(*(described(c) for c in names)).alias("rows"))
    return one.select(F.explode("rows").alias("r")).select("r.*")


def _spearman_row(wh: Warehouse) -> DataFrame:
    """(n, rho) from the joint histogram: one aggregate over the sample, ranks and products on its cells.

    The mean of average ranks is (n + 1) / 2 for either variable.
    """
    joint = installment_review_sample(wh).groupBy("installments", "review_score").agg(F.count(F.lit(1)).alias("c"))

    def ranks(c: str, name: str) -> DataFrame:
        return histogram_ranks(joint.groupBy(c).agg(F.sum("c").alias("n")), c, closed=True).select(c, F.col("avg_rank").alias(name))

    cells = joint.join(ranks("installments", "rx"), "installments").join(ranks("review_score", "ry"), "review_score")
    sums = cells.agg(
        F.sum("c").cast("long").alias("n"),
        F.sum(F.col("c") * F.col("rx") * F.col("ry")).alias("xy"),
        F.sum(F.col("c") * F.col("rx") * F.col("rx")).alias("xx"),
        F.sum(F.col("c") * F.col("ry") * F.col("ry")).alias("yy"),
    )
    n = F.col("n").cast("double")
    square = n * (n + 1) * (n + 1) / 4
    rho = safe_div(F.col("xy") - square, F.sqrt((F.col("xx") - square) * (F.col("yy") - square)))
    return sums.select("n", rho.alias("rho"))


def spearman(wh: Warehouse) -> DataFrame:
    """Spearman's rho of instalments and review score (average ranks for ties)."""
    return _spearman_row(wh).select("n", r6("rho").alias("rho"))


def mean_score_by_installments(wh: Warehouse, max_installments: int = MAX_INSTALLMENTS_SHOWN) -> DataFrame:
    """Mean review score per instalment count, up to a cut-off."""
    return (
        installment_review_sample(wh)
        .groupBy("installments")
        .agg(r6(F.avg("review_score")).alias("mean_review_score"))
        .where(F.col("installments") <= max_installments)
        .orderBy("installments")
    )


# -- test results with p-values ----------------------------------------------


def _with_p(test: DataFrame) -> DataFrame:
    """The row of a Mann-Whitney test with its two-sided p.

    Small samples without ties get the exact p (one sample of at most dist.EXACT_SIZE values, at most dist.EXACT_CELLS
    pairs of values); all others the normal approximation, tie and continuity corrected.
    """
    n1, n2, u = F.col("n_late").cast("double"), F.col("n_on_time").cast("double"), F.col("u_statistic")
    small = (F.col("tie_term") == 0) & (F.least(n1, n2) <= dist.EXACT_SIZE) & (n1 * n2 <= dist.EXACT_CELLS)
    p = F.when(small, dist.two_sided_u(n1, n2, u)).otherwise(dist.two_sided_norm(F.col("z")))
    return test.select("n_late", "n_on_time", "u_statistic", p.alias("p_value"))


def mann_whitney_p(wh: Warehouse) -> DataFrame:
    """T3 with its two-sided p."""
    return _with_p(_mann_whitney_row(wh))


def weekday_means(wh: Warehouse) -> DataFrame:
    """Mean review score of late and of on-time orders per weekday of purchase: delivery_group, weekday, mean_score."""
    bought = wh["orders"].select("order_id", F.dayofweek("order_purchase_timestamp").alias("weekday")).where("weekday IS NOT NULL")
    return late_review_sample(wh).join(bought, "order_id").groupBy("delivery_group", "weekday").agg(F.avg("review_score").alias("mean_score"))


def weekday_means_p(wh: Warehouse) -> DataFrame:
    """Mann-Whitney test of the weekdays' mean scores, late against on-time: seven values a side, so p is exact without ties."""
    return _with_p(mann_whitney_of(weekday_means(wh), "mean_score"))


def welch_p(wh: Warehouse) -> DataFrame:
    """T4 with its two-sided p (Student t with Welch–Satterthwaite df, both unrounded)."""
    return _welch_row(wh).withColumn("p_value", dist.two_sided_t(F.col("t_statistic"), F.col("df")))


def spearman_p(wh: Warehouse) -> DataFrame:
    """T9 with its two-sided p (t = rho sqrt((n-2)/(1-rho^2)), n-2 df)."""
    rho, n = F.col("rho"), F.col("n")
    t = rho * F.sqrt(safe_div(n - 2, F.lit(1.0) - rho * rho))
    p = F.when(n < 3, F.lit(None).cast("double")).when(F.abs(rho) >= 1, F.lit(0.0)).otherwise(dist.two_sided_t(t, n - 2))
    return _spearman_row(wh).select("n", "rho", p.alias("p_value"))


P_DIGITS = 9


def rounded(test: DataFrame) -> DataFrame:
    """A test's row for a report: statistics to six, p to P_DIGITS decimals (rounded last)."""
    return test.select(
        *(
            r2(c, P_DIGITS).alias(c) if c == "p_value" else r6(c).alias(c) if t == "double" else F.col(c)
            for c, t in test.dtypes
        )
    )


def mann_whitney_test(wh: Warehouse) -> dict:
    return mann_whitney_p(wh).first().asDict()


def welch_test(wh: Warehouse) -> dict:
    return welch_p(wh).first().asDict()


def spearman_test(wh: Warehouse) -> dict:
    return spearman_p(wh).first().asDict()
