
from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from souk.plans import cohort, delivery, payments, rfm, stats
from souk.sources import warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse.from_driver(spark, SF)


def _close(a, b, tol=0.05):
    return math.isclose(a, b, abs_tol=tol)


def test_shares_sum_to_100(wh):
    mix = payments.payment_type_mix(wh).agg(F.sum("pct_of_payments"), F.sum("pct_of_revenue")).first()
    assert _close(mix[0], 100.0) and _close(mix[1], 100.0)
    inst = payments.installment_distribution(wh).agg(F.sum("pct_of_payments")).first()[0]
    assert _close(inst, 100.0)
    rate = delivery.delivery_rate_overall(wh).agg(F.sum("pct_of_orders")).first()[0]
    assert _close(rate, 100.0)


def test_month0_retention_is_100_and_matches_cohort_sizes(wh):
    m = cohort.cohort_retention_matrix(wh)
    m0 = {r.cohort_month: r for r in m.where(F.col("months_since_first") == 0).collect()}
    assert all(r.retention_pct == 100.0 and r.active_customers == r.cohort_size for r in m0.values())
    sizes = {r.cohort_month: r.cohort_size for r in cohort.cohort_sizes(wh).collect()}
    assert sizes == {k: r.cohort_size for k, r in m0.items()}
    assert m.where(F.col("months_since_first") < 0).count() == 0


def test_segment_counts_cover_every_person(wh):
    people = rfm.rfm_customers(wh)
    n = people.count()
    summary = rfm.rfm_segment_summary(wh)
    assert summary.agg(F.sum("customer_count")).first()[0] == n
    got = {r.segment: r.customer_count for r in summary.collect()}
    want = {r.segment: r["count"] for r in people.groupBy("segment").count().collect()}
    assert got == want
    # NTILE buckets differ in size by at most one
    for c in ("r_score", "f_score", "m_score"):
        sizes = [r["count"] for r in people.groupBy(c).count().collect()]
        assert max(sizes) - min(sizes) <= 1


def test_u_statistics_sum_to_n1_n2(wh):
    r = stats.mann_whitney(wh).first()
    u2 = r.n_late * r.n_on_time - r.u_statistic
    assert u2 >= 0 and math.isclose(r.u_statistic + u2, r.n_late * r.n_on_time)
    rb = stats.rank_biserial(wh).first().rank_biserial
    assert -1.0 <= rb <= 1.0
