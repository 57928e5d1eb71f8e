"""Exploratory queries (E1–E9): table sizes, completeness, funnels, top lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.plans.base import Warehouse
from souk.plans.views import mart
from souk.sources.schemas import LOAD_ORDER


def table_row_counts(wh: Warehouse, tables: list[str] | None = None) -> DataFrame:
    """Rows per table, largest first (one global count per table)."""
    parts = [
        wh[t].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in (tables or LOAD_ORDER)
    ]
    return reduce(DataFrame.unionByName, parts).orderBy(F.col("row_count").desc(), "table_name")


def _missing(df: DataFrame, cols: dict[str, str], total: str) -> DataFrame:
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(alias) for alias, c in cols.items()],
        F.count(F.lit(1)).alias(total),
    )


def missing_in_orders(wh: Warehouse) -> DataFrame:
    """Missing timestamps / delay in orders."""
    return _missing(
        wh["orders"],
        {
            "missing_approved_at": "order_approved_at",
            "missing_carrier_date": "order_delivered_carrier_date",
            "missing_delivered_date": "order_delivered_customer_date",
            "missing_delivery_delay": "delivery_delay_days",
        },
        "total_orders",
    )


def undelivered_status(wh: Warehouse) -> DataFrame:
    """Status of orders without a delivery date."""
    return (
        wh["orders"]
        .where(F.col("order_delivered_customer_date").isNull())
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .orderBy(F.col("n_orders").desc(), "order_status")
    )


def missing_in_reviews(wh: Warehouse) -> DataFrame:
    """Reviews without title / message."""
    return _missing(
        wh["order_reviews"],
        {"missing_title": "review_comment_title", "missing_message": "review_comment_message"},
        "total_reviews",
    )


def missing_in_products(wh: Warehouse) -> DataFrame:
    """E5: products without category / weight."""
    return _missing(
        wh["products"],
        {"missing_category": "product_category_name", "missing_weight": "product_weight_g"},
        "total_products",
    )


def status_funnel(wh: Warehouse) -> DataFrame:
    """Orders per status, most frequent first."""
    return (
        wh["orders"]
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .orderBy(F.col("n_orders").desc(), "order_status")
    )


def review_distribution(wh: Warehouse) -> DataFrame:
    """Reviews per score."""
    return (
        wh["order_reviews"]
        .groupBy("review_score")
        .agg(F.count(F.lit(1)).alias("n_reviews"))
        .orderBy(F.col("review_score").asc_nulls_last())
    )


def top_categories_by_revenue(wh: Warehouse, k: int = 15) -> DataFrame:
    """The category mart's top k by revenue."""
    return (
        mart(wh, "revenue_by_category")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "category")
        .limit(k)
    )


def top_categories_by_volume(wh: Warehouse, k: int = 15) -> DataFrame:
    """The category mart re-ranked by line items."""
    return mart(wh, "revenue_by_category").orderBy(F.col("line_items").desc(), "category").limit(k)


def top_states_by_revenue(wh: Warehouse, k: int) -> DataFrame:
    """The state mart's top k by revenue."""
    return (
        mart(wh, "revenue_by_state")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "customer_state")
        .limit(k)
    )
