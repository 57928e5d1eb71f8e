"""Building blocks shared by the marts.

Every builder takes ``wh`` — a mapping table name -> DataFrame holding the
nine clean warehouse tables — and returns a lazy DataFrame.  Order-level
facts are aggregated to one row per order *before* they are joined, so a
join never fans out and a hot order is reduced map-side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.exprs import money

Warehouse = Mapping[str, DataFrame]

REVIEW_COLUMNS = ("reviews", "score_sum", "score_n", "bad_n")

DELIVERED = "delivered"
CREDIT_CARD = "credit_card"
TOTAL = "decimal(32,10)"  # of exact money sums


# Key under which a job may hand the builders the stored per-order facts.
FACTS = "order_facts"


def _review_sums() -> tuple[Column, ...]:
    score = F.col("review_score")
    return (F.count(F.lit(1)).alias("reviews"), F.sum(score).alias("score_sum"), F.count(score).alias("score_n"), F.count_if(score <= 2).alias("bad_n"))


def order_facts(wh: Warehouse) -> DataFrame:
    """One row per delivered order: what the order marts need of orders, payments and reviews.

    The export job writes this once; the builders then read it instead of
    aggregating payments and reviews per order again and again.
    """
    reviews = wh["order_reviews"].groupBy("order_id").agg(*_review_sums())
    paid = wh["order_payments"].groupBy("order_id").agg(
        F.sum("payment_value").alias("order_revenue"), F.sum(money("payment_value")).cast(TOTAL).alias("revenue")
    )
    orders = wh["orders"].where(F.col("order_status") == DELIVERED).drop("order_status")
    return orders.join(paid, "order_id", "left").join(reviews, "order_id", "left")


def delivered_orders(wh: Warehouse, *cols: str) -> DataFrame:
    if FACTS in wh:
        return wh[FACTS].select("order_id", *cols)
    return wh["orders"].where(F.col("order_status") == DELIVERED).select("order_id", *cols)


def delivered_with_date(wh: Warehouse, *cols: str) -> DataFrame:
    """Delivered orders that carry a delivery date (basis of the delivery marts)."""
    dated = delivered_orders(wh, "order_delivered_customer_date", *cols)
    return dated.where(F.col("order_delivered_customer_date").isNotNull()).select("order_id", *cols)


def paid_delivered_orders(wh: Warehouse, *cols: str) -> DataFrame:
    """One row per delivered order that has at least one payment, with its exact revenue."""
    if FACTS in wh:
        return wh[FACTS].where(F.col("revenue").isNotNull()).select("order_id", *cols, "revenue")
    return delivered_orders(wh, *cols).join(order_money(wh), "order_id")


def reviewed_delivered_orders(wh: Warehouse, *cols: str) -> DataFrame:
    """Delivered, dated orders with a review, and the sums over their reviews."""
    if FACTS in wh:
        f = wh[FACTS].where(F.col("order_delivered_customer_date").isNotNull() & F.col("reviews").isNotNull())
        return f.select("order_id", *cols, *REVIEW_COLUMNS)
    return delivered_with_date(wh, *cols).join(wh["order_reviews"].groupBy("order_id").agg(*_review_sums()), "order_id")


def order_amounts(wh: Warehouse) -> DataFrame:
    """(order_id, order_revenue): what the payments of each paid, delivered order add up to (double)."""
    if FACTS in wh:
        return wh[FACTS].where(F.col("order_revenue").isNotNull()).select("order_id", "order_revenue")
    paid = wh["order_payments"].groupBy("order_id").agg(F.sum("payment_value").alias("order_revenue"))
    return delivered_orders(wh).join(paid, "order_id")


def order_money(wh: Warehouse) -> DataFrame:
    """(order_id, revenue): the exact decimal sum of each order's payments."""
    return wh["order_payments"].groupBy("order_id").agg(F.sum(money("payment_value")).cast(TOTAL).alias("revenue"))


def delay_status(c: str = "delivery_delay_days", late: str = "late", other: str = "on_time"):
    """'late' when the delay is positive; NULL delay falls to the other label."""
    return F.when(F.col(c) > 0, F.lit(late)).otherwise(F.lit(other))


def category_of(products: DataFrame) -> DataFrame:
    """(product_id, category) with 'unknown' for a missing English name."""
    return products.select(
        "product_id", F.coalesce(F.col("product_category_name_english"), F.lit("unknown")).alias("category")
    )
