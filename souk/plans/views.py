"""Report-ready shapes read by the dashboard pages.

Each view shapes one or two marts.  ``wh`` may hold the stored marts (see
``pipeline.stored_marts``), which the views then read as the dashboard
does; otherwise the marts are computed from the warehouse tables.  Only
the final handful of rows reaches a client.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.exprs import label_text, r2
from souk.plans.base import Warehouse

MIN_MONTH_ORDERS = 5
RETENTION_OFFSETS = list(range(12))

# Plain-language definition of each segment.
SEGMENT_DEFINITIONS = {
    "Champions": "Bought recently, buy often, spend the most",
    "Loyal Customers": "Buy regularly with good recency/frequency",
    "New Customers": "Bought recently but low frequency so far",
    "Big Spenders": "Spend a lot, decent recency, low frequency",
    "At Risk": "Used to buy often, haven't purchased recently",
    "Cant Lose Them": "High spend historically, gone quiet",
    "Hibernating": "Low recency, frequency, and monetary — inactive",
    "Needs Attention": "Below-average across the board",
}


def mart(wh: Warehouse, name: str) -> DataFrame:
    """The named mart: read from ``wh`` when it holds the stored mart (as
    written by the export job), otherwise computed from the warehouse tables."""
    if name in wh:
        return wh[name]
    from souk.plans.registry import MARTS

    return MARTS[name][1](wh)


def kpi_row(wh: Warehouse) -> DataFrame:
    """The headline indicators."""
    return mart(wh, "summary_kpis")


def monthly_trend_view(wh: Warehouse, min_orders: int = MIN_MONTH_ORDERS) -> DataFrame:
    """Monthly trend without thin months, in month order."""
    return (
        mart(wh, "monthly_revenue_trend")
        .where(F.col("order_count") >= min_orders)
        .orderBy("order_purchase_month")
    )


def top_category(wh: Warehouse) -> DataFrame:
    """D3: the single biggest category by revenue, with a display label."""
    return (
        mart(wh, "revenue_by_category")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "category")
        .limit(1)
        .select("category", label_text("category").alias("category_label"), "total_revenue")
    )


def top_state(wh: Warehouse) -> DataFrame:
    """D3: the state with the most revenue, its revenue and orders."""
    return (
        mart(wh, "revenue_by_state")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "customer_state")
        .limit(1)
        .select("customer_state", "total_revenue", "order_count")
    )


def state_revenue_bars(wh: Warehouse, k: int = 15) -> DataFrame:
    """D3: the k states with most revenue, smallest first (bar order)."""
    top = (
        mart(wh, "revenue_by_state")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "customer_state")
        .limit(k)
        .select("customer_state", "total_revenue")
    )
    return top.orderBy(F.col("total_revenue").asc_nulls_first(), F.col("customer_state").desc())


def segment_table(wh: Warehouse) -> DataFrame:
    """Segment summary with its definition ('' for an unknown segment)."""
    defs = F.create_map(*[F.lit(x) for kv in SEGMENT_DEFINITIONS.items() for x in kv])
    return mart(wh, "rfm_segment_summary").select(
        "segment",
        F.coalesce(defs[F.col("segment")], F.lit("")).alias("definition"),
        "customer_count",
        "total_revenue",
        "avg_revenue_per_customer",
    ).orderBy(F.col("total_revenue").desc_nulls_last(), "segment")


def top_segment(wh: Warehouse) -> DataFrame:
    """The segment with most revenue."""
    return (
        mart(wh, "rfm_segment_summary")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "segment")
        .limit(1)
        .select("segment", "total_revenue", "customer_count")
    )


def retention_wide(wh: Warehouse) -> DataFrame:
    """Cohort x month-offset matrix of retention, offsets 0..11 as columns m0..m11."""
    m = mart(wh, "cohort_retention_matrix").where(F.col("months_since_first") <= RETENTION_OFFSETS[-1])
    wide = m.groupBy("cohort_month").pivot("months_since_first", RETENTION_OFFSETS).agg(
        F.first("retention_pct")
    )
    return wide.select(
        F.col("cohort_month").cast("string").alias("cohort_month"),
        *[F.col(str(k)).alias(f"m{k}") for k in RETENTION_OFFSETS],
    ).orderBy("cohort_month")


def month1_retention(wh: Warehouse) -> DataFrame:
    """Unweighted mean month-1 retention over cohorts having a month-1 cell (NULL if none)."""
    return (
        mart(wh, "cohort_retention_matrix")
        .where(F.col("months_since_first") == 1)
        .agg(r2(F.avg("retention_pct")).alias("avg_m1_retention"))
    )


def late_vs_on_time(wh: Warehouse) -> DataFrame:
    """Rates, mean scores, score gap and bad-review shares side by side."""
    rate = mart(wh, "delivery_rate_overall").agg(
        F.max(F.when(F.col("delivery_status") == "on_time", F.col("pct_of_orders"))).alias("on_time_pct"),
        F.max(F.when(F.col("delivery_status") == "late", F.col("pct_of_orders"))).alias("late_pct"),
    )
    rev = mart(wh, "review_score_by_delivery").agg(
        F.max(F.when(F.col("delivery_status") == "on_time", F.col("avg_review_score"))).alias("score_on_time"),
        F.max(F.when(F.col("delivery_status") == "late", F.col("avg_review_score"))).alias("score_late"),
        F.max(F.when(F.col("delivery_status") == "on_time", F.col("pct_bad_reviews"))).alias("bad_on_time"),
        F.max(F.when(F.col("delivery_status") == "late", F.col("pct_bad_reviews"))).alias("bad_late"),
    )
    return rate.crossJoin(rev).select(
        "on_time_pct",
        "late_pct",
        "score_on_time",
        "score_late",
        r2(F.col("score_late") - F.col("score_on_time")).alias("score_gap"),
        "bad_on_time",
        "bad_late",
    )


def worst_best_state(wh: Warehouse) -> DataFrame:
    """Highest and lowest late share (ties: alphabetically first state)."""
    by_state = mart(wh, "delivery_delay_by_state")
    worst = by_state.orderBy(F.col("late_pct").desc_nulls_last(), "customer_state").limit(1).select(
        F.col("customer_state").alias("worst_state"), F.col("late_pct").alias("worst_late_pct")
    )
    best = by_state.orderBy(F.col("late_pct").asc_nulls_last(), "customer_state").limit(1).select(
        F.col("customer_state").alias("best_state"), F.col("late_pct").alias("best_late_pct")
    )
    return worst.crossJoin(best)


def dominant_payment(wh: Warehouse) -> DataFrame:
    """Payment type with most revenue, display label and revenue share."""
    return (
        mart(wh, "payment_type_mix")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "payment_type")
        .limit(1)
        .select("payment_type", label_text("payment_type").alias("payment_label"), "pct_of_revenue")
    )


def single_installment_share(wh: Warehouse) -> DataFrame:
    """Share of payments made in one instalment (NULL when there are none)."""
    return mart(wh, "installment_distribution").agg(
        F.max(F.when(F.col("payment_installments") == 1, F.col("pct_of_payments"))).alias(
            "pct_single_installment"
        )
    )


def most_installments_category(wh: Warehouse) -> DataFrame:
    """Category with the highest mean credit-card instalments."""
    return (
        mart(wh, "credit_card_installments_by_category")
        .orderBy(F.col("avg_installments").desc_nulls_last(), "category")
        .limit(1)
        .select("category", label_text("category").alias("category_label"), "avg_installments")
    )
