"""Recency / frequency / monetary scoring per person (M04) and per segment.

The three NTILE(5) scores are global rankings; they run through
``ntile_many`` (range partitioning + per-partition offsets), never through a
window without partition key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.exprs import money_avg, money_value
from souk.operators.ranks import ntile_many
from souk.plans.base import TOTAL, Warehouse, paid_delivered_orders

# Segment rules, checked in this order (first match wins);
# each rule is a list of (score, comparison, bound) that must all hold.
SEGMENT_RULES = [
    ("Champions", [("r", ">=", 4), ("f", ">=", 4), ("m", ">=", 4)]),
    ("Loyal Customers", [("r", ">=", 3), ("f", ">=", 3)]),
    ("New Customers", [("r", ">=", 4), ("f", "<=", 2)]),
    ("Big Spenders", [("r", ">=", 3), ("m", ">=", 4)]),
    ("At Risk", [("r", "<=", 2), ("f", ">=", 4)]),
    ("Cant Lose Them", [("r", "<=", 2), ("m", ">=", 4)]),
    ("Hibernating", [("r", "<=", 2), ("f", "<=", 2), ("m", "<=", 2)]),
]
DEFAULT_SEGMENT = "Needs Attention"


def segment_of(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    cols = {"r": F.col(r), "f": F.col(f), "m": F.col(m)}
    expr = None
    for name, tests in SEGMENT_RULES:
        cond = None
        for score, op, bound in tests:
            t = cols[score] >= bound if op == ">=" else cols[score] <= bound
            cond = t if cond is None else cond & t
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(DEFAULT_SEGMENT))


def customer_rfm(wh: Warehouse) -> DataFrame:
    """(customer_unique_id, last_day, frequency, monetary_exact) over delivered, paid orders.

    ``last_day`` is the day of the person's latest purchase as days since
    1970-01-01.  Orders are reduced to one row per customer_id before the
    person lookup (a customer id with very many orders is combined
    map-side), then merged per person.
    """
    people = wh["customers"].select("customer_id", "customer_unique_id")
    per_customer = (
        paid_delivered_orders(wh, "customer_id", "order_purchase_timestamp")
        .groupBy("customer_id")
        .agg(
            F.max("order_purchase_timestamp").alias("last_ts"),
            F.count(F.lit(1)).alias("n"),
            F.sum("revenue").cast(TOTAL).alias("total"),
        )
    )
    return (
        per_customer.join(people, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.unix_date(F.to_date(F.max("last_ts"))).alias("last_day"),
            F.sum("n").cast("long").alias("frequency"),
            F.sum("total").cast(TOTAL).alias("monetary_exact"),
        )
    )


# Key under which a job may hand an already scored table to the builders
# (the export job scores once for both RFM marts).
SCORED_KEY = "rfm_scored_customers"


def scored_customers(wh: Warehouse) -> DataFrame:
    """customer_rfm plus r/f/m scores (ties broken by customer_unique_id).

    Recency is days from the last purchase day to the snapshot day (the
    latest purchase day of all), so ordering by recency descending is
    ordering by last purchase day ascending, with the same ties; the scores
    are computed on that, and the snapshot comes with the ranking's
    per-partition counts instead of a second pass.
    """
    if SCORED_KEY in wh:
        return wh[SCORED_KEY]
    return ntile_many(
        customer_rfm(wh),
        "customer_unique_id",
        {
            "r_score": ("last_day", True),  # older last purchase = larger recency = lower score
            "f_score": ("frequency", True),
            "m_score": ("monetary_exact", True),
        },
        k=5,
        maxima={"snapshot_day": "last_day"},
    )


def rfm_customers(wh: Warehouse) -> DataFrame:
    """One row per person with scores and segment."""
    return scored_customers(wh).select(
        "customer_unique_id",
        (F.col("snapshot_day") - F.col("last_day")).cast("long").alias("recency_days"),
        "frequency",
        money_value("monetary_exact").alias("monetary"),
        "r_score",
        "f_score",
        "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_score"),
        segment_of().alias("segment"),
    )


def rfm_scores(wh: Warehouse) -> DataFrame:
    """The three NTILE(5) scores alone."""
    return scored_customers(wh).select("customer_unique_id", "r_score", "f_score", "m_score")


def rfm_segment_summary(wh: Warehouse) -> DataFrame:
    """Persons and revenue per segment (sums the unrounded monetary value)."""
    s = scored_customers(wh).select("monetary_exact", segment_of().alias("segment"))
    return (
        s.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customer_count"), F.sum("monetary_exact").cast(TOTAL).alias("_total"))
        .select(
            "segment",
            "customer_count",
            money_value("_total").alias("total_revenue"),
            money_avg("_total", "customer_count").alias("avg_revenue_per_customer"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("segment"))
    )
