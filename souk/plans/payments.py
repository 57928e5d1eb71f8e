"""Payment behaviour marts (M11–M14): rows of order_payments, not orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.exprs import money, money_avg, pct, r2
from souk.operators.totals import with_grand_totals
from souk.plans.base import CREDIT_CARD, TOTAL, Warehouse, category_of

MIN_CATEGORY_PAYMENTS = 30
CATEGORY_TOP_K = 20


def payment_type_mix(wh: Warehouse) -> DataFrame:
    """Payment rows and value per type, each as a share of the whole."""
    g = wh["order_payments"].groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payment_count"), F.sum("payment_value").alias("_value")
    )
    return (
        with_grand_totals(g, {"_n_all": "payment_count", "_v_all": "_value"})
        .select(
            "payment_type",
            "payment_count",
            r2(pct("payment_count", "_n_all")).alias("pct_of_payments"),
            r2("_value").alias("total_revenue"),
            r2(pct("_value", "_v_all")).alias("pct_of_revenue"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), "payment_type")
    )


def installment_distribution(wh: Warehouse) -> DataFrame:
    """Payment rows and value per instalment count, all payment types."""
    g = wh["order_payments"].groupBy("payment_installments").agg(
        F.count(F.lit(1)).alias("payment_count"), F.sum("payment_value").alias("_value")
    )
    return (
        with_grand_totals(g, {"_n_all": "payment_count"})
        .select(
            "payment_installments",
            "payment_count",
            r2(pct("payment_count", "_n_all")).alias("pct_of_payments"),
            r2("_value").alias("total_revenue"),
        )
        .orderBy("payment_installments")
    )


def avg_payment_value_by_installments(wh: Warehouse) -> DataFrame:
    """Credit-card payments per instalment count and their mean value."""
    return (
        wh["order_payments"]
        .where(F.col("payment_type") == CREDIT_CARD)
        .groupBy("payment_installments")
        .agg(F.count(F.lit(1)).alias("payment_count"), F.sum(money("payment_value")).cast(TOTAL).alias("_total"))
        .select("payment_installments", "payment_count", money_avg("_total", "payment_count").alias("avg_payment_value"))
        .orderBy("payment_installments")
    )


def top_item_product(wh: Warehouse) -> DataFrame:
    """(order_id, product_id) of each order's dearest item; ties go to the lowest item number.

    Written as row_number = 1 so Catalyst plans a per-group limit before
    the shuffle (a hot order is cut to one row per map task).
    """
    w = Window.partitionBy("order_id").orderBy(F.col("price").desc(), F.col("order_item_id").asc())
    return (
        wh["order_items"]
        .select("order_id", "order_item_id", "product_id", "price")
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select("order_id", "product_id")
    )


def credit_card_category_all(wh: Warehouse) -> DataFrame:
    """Credit-card payments per category of the order's dearest item (no cut-offs)."""
    per_order = (
        wh["order_payments"]
        .where(F.col("payment_type") == CREDIT_CARD)
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("payment_installments").alias("inst_sum"),
            F.sum(money("payment_value")).cast(TOTAL).alias("value_sum"),
        )
    )
    per_product = (
        per_order.join(top_item_product(wh), "order_id")
        .groupBy("product_id")
        .agg(F.sum("n").alias("n"), F.sum("inst_sum").alias("inst_sum"), F.sum("value_sum").cast(TOTAL).alias("value_sum"))
    )
    g = (
        per_product.join(category_of(wh["products"]), "product_id", "left")
        .select(F.coalesce(F.col("category"), F.lit("unknown")).alias("category"), "n", "inst_sum", "value_sum")
        .groupBy("category")
        .agg(F.sum("n").alias("n"), F.sum("inst_sum").alias("inst_sum"), F.sum("value_sum").cast(TOTAL).alias("value_sum"))
    )
    return g.select(
        "category",
        F.col("n").cast("long").alias("payment_count"),
        r2(F.col("inst_sum").cast("double") / F.col("n")).alias("avg_installments"),
        money_avg("value_sum", "n").alias("avg_payment_value"),
    )


def credit_card_installments_by_category(
    wh: Warehouse, min_payments: int = MIN_CATEGORY_PAYMENTS, top_k: int = CATEGORY_TOP_K
) -> DataFrame:
    """Categories with at least ``min_payments`` credit-card payments, top by mean instalments."""
    return (
        credit_card_category_all(wh)
        .where(F.col("payment_count") >= min_payments)
        .orderBy(F.col("avg_installments").desc_nulls_last(), "category")
        .limit(top_k)
    )
