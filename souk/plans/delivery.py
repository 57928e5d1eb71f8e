"""Delivery reliability (M08, M09) and its link to review scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.exprs import pct, r2
from souk.operators.totals import with_grand_totals
from souk.plans.base import Warehouse, delay_status, delivered_with_date, reviewed_delivered_orders


def delivery_rate_overall(wh: Warehouse) -> DataFrame:
    """On-time vs late orders, share of all, mean delay (NULL delay counts as on time)."""
    grouped = (
        delivered_with_date(wh, "delivery_delay_days")
        .withColumn("delivery_status", delay_status())
        .groupBy("delivery_status")
        .agg(F.count(F.lit(1)).alias("order_count"), F.avg("delivery_delay_days").alias("_avg"))
    )
    return (
        with_grand_totals(grouped, {"_all": "order_count"})
        .select(
            "delivery_status",
            "order_count",
            r2(pct("order_count", "_all")).alias("pct_of_orders"),
            r2("_avg").alias("avg_delay_days"),
        )
        .orderBy("delivery_status")
    )


def delivery_delay_by_state(wh: Warehouse) -> DataFrame:
    """Orders, mean delay and late share per customer state."""
    per_customer = (
        delivered_with_date(wh, "customer_id", "delivery_delay_days")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("delivery_delay_days").alias("delay_sum"),
            F.count("delivery_delay_days").alias("delay_n"),
            F.count_if(F.col("delivery_delay_days") > 0).alias("late_n"),
        )
    )
    states = wh["customers"].select("customer_id", "customer_state")
    g = (
        per_customer.join(states, "customer_id")
        .groupBy("customer_state")
        .agg(
            F.sum("n").alias("n"),
            F.sum("delay_sum").alias("delay_sum"),
            F.sum("delay_n").alias("delay_n"),
            F.sum("late_n").alias("late_n"),
        )
    )
    return g.select(
        "customer_state",
        F.col("n").cast("long").alias("order_count"),
        r2(F.col("delay_sum").cast("double") / F.nullif(F.col("delay_n"), F.lit(0))).alias("avg_delay_days"),
        r2(pct("late_n", "n")).alias("late_pct"),
    ).orderBy(F.col("late_pct").desc_nulls_last(), "customer_state")


def review_score_by_delivery(wh: Warehouse) -> DataFrame:
    """Reviews (rows, not orders) per delivery status, mean score, share of score <= 2."""
    g = (
        reviewed_delivered_orders(wh, "delivery_delay_days")
        .withColumn("delivery_status", delay_status())
        .groupBy("delivery_status")
        .agg(
            F.sum("reviews").alias("n"),
            F.sum("score_sum").alias("score_sum"),
            F.sum("score_n").alias("score_n"),
            F.sum("bad_n").alias("bad_n"),
        )
    )
    return g.select(
        "delivery_status",
        F.col("n").cast("long").alias("review_count"),
        r2(F.col("score_sum").cast("double") / F.nullif(F.col("score_n"), F.lit(0))).alias("avg_review_score"),
        r2(pct("bad_n", "n")).alias("pct_bad_reviews"),
    ).orderBy("delivery_status")
