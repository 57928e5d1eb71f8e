"""Headline indicators (M15 summary_kpis, the dashboard's KPI row).

The dashboard reads this mart but no query of the analysed project writes
it; the definition here follows the sales marts: delivered orders only,
revenue = their payments, orders = delivered orders with a payment,
average order value = revenue / orders, mean review score over the reviews
of delivered orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.exprs import money_avg, money_value, r2, safe_div
from souk.plans.base import FACTS, TOTAL, Warehouse, order_facts


def summary_kpis(wh: Warehouse) -> DataFrame:
    """One row.  Delivered orders are read once: each carries its payment
    total and its review count and score sum (both pre-aggregated per order,
    joined on order_id), and a single global aggregate produces all four
    figures."""
    per_order = order_facts(wh) if FACTS not in wh else wh[FACTS]
    g = per_order.agg(
        F.count("revenue").alias("total_orders"),  # delivered orders with a payment
        F.sum("revenue").cast(TOTAL).alias("_total"),
        F.sum("score_n").alias("_reviews"),
        F.sum("score_sum").alias("_score_sum"),
    )
    return g.select(
        money_value("_total").alias("total_revenue"),
        "total_orders",
        money_avg("_total", "total_orders").alias("avg_order_value"),
        r2(safe_div("_score_sum", "_reviews")).alias("avg_review_score"),
    )
