"""Sales marts: monthly trend (M01), revenue by category (M02), by state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.exprs import money_avg, money_value, r2, safe_div
from souk.plans.base import TOTAL, Warehouse, category_of, order_amounts, paid_delivered_orders

CATEGORY_TOP_K = 15


def monthly_revenue_trend(wh: Warehouse) -> DataFrame:
    """Orders, revenue and average order value per purchase month
    (money is summed as exact decimals, so the average rounds the same way on
    any partitioning)."""
    per_order = paid_delivered_orders(wh, "order_purchase_month")
    return (
        per_order.groupBy("order_purchase_month")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("revenue").cast(TOTAL).alias("_total"))
        .select(
            "order_purchase_month",
            "order_count",
            money_value("_total").alias("total_revenue"),
            money_avg("_total", "order_count").alias("avg_order_value"),
        )
        .orderBy(F.col("order_purchase_month").asc_nulls_last())
    )


SALTS = 16
#: An order is hot if it has at least HOT_PRODUCTS distinct products and at least 1 / HOT_SHARE of all orders' products;
#: there are at most HOT_SHARE hot orders.
HOT_PRODUCTS = 256
HOT_SHARE = 1000


def order_lines(wh: Warehouse) -> DataFrame:
    """Item price and lines per (order, product)."""
    return wh["order_items"].groupBy("order_id", "product_id").agg(F.sum("price").alias("price"), F.count(F.lit(1)).alias("lines"))


def order_totals(wh: Warehouse) -> DataFrame:
    """Price and distinct products per order, counted over the grouped lines."""
    return order_lines(wh).groupBy("order_id").agg(F.sum("price").alias("order_price"), F.count(F.lit(1)).alias("products"))


def hot_orders(wh: Warehouse) -> DataFrame:
    """order_id of the hot orders."""
    many = order_totals(wh).where(F.col("products") >= HOT_PRODUCTS).select("order_id", "products")
    total = order_lines(wh).agg(F.count(F.lit(1)).alias("total"))
    return many.join(F.broadcast(total), F.col("products") * HOT_SHARE >= F.col("total")).select("order_id")


def salted_lines(wh: Warehouse, hot: DataFrame | None = None) -> DataFrame:
    """Item price and lines per (order, product), with the share a hot order's products are dealt to (others have one share)."""
    hot = F.broadcast((hot_orders(wh) if hot is None else hot).select(F.col("order_id").alias("_hot")))
    lines = order_lines(wh).join(hot, F.col("order_id") == F.col("_hot"), "left")
    return lines.withColumn("_salt", F.when(F.col("_hot").isNull(), 0).otherwise(F.pmod(F.hash("product_id"), F.lit(SALTS)))).drop("_hot")


def category_revenue_all(wh: Warehouse) -> DataFrame:
    """Revenue of delivered orders allocated to items by price share, per category
    (all categories, before the top-k cut).

    Items are summed per (order, product) first, so an order is as many rows
    as it has distinct products; a hot order is dealt by product over SALTS
    shares, each of which meets a copy of the order's one ratio (revenue per
    unit of price).  All other orders meet their ratio plainly.
    """
    hot = hot_orders(wh)
    ratio = (
        order_totals(wh)
        .join(order_amounts(wh), "order_id")
        .select("order_id", safe_div("order_revenue", "order_price").alias("ratio"))
        .join(F.broadcast(hot.select(F.col("order_id").alias("_hot"))), F.col("order_id") == F.col("_hot"), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col("_hot").isNull(), 0).otherwise(SALTS - 1))))
        .drop("_hot")
    )
    allocated = salted_lines(wh, hot).join(ratio, ["order_id", "_salt"])
    # pre-aggregate per product so the product lookup joins one row per product
    per_product = allocated.groupBy("product_id").agg(
        F.sum(F.col("price") * F.col("ratio")).alias("revenue"), F.sum("lines").alias("lines")
    )
    with_cat = per_product.join(category_of(wh["products"]), "product_id", "left").select(
        F.coalesce(F.col("category"), F.lit("unknown")).alias("category"), "revenue", "lines"
    )
    return with_cat.groupBy("category").agg(
        r2(F.sum("revenue")).alias("total_revenue"), F.sum("lines").cast("long").alias("line_items")
    )


def revenue_by_category(wh: Warehouse, top_k: int = CATEGORY_TOP_K) -> DataFrame:
    """Top categories by allocated revenue (ties broken by category name)."""
    return (
        category_revenue_all(wh)
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("category").asc_nulls_last())
        .limit(top_k)
    )


def revenue_by_state(wh: Warehouse) -> DataFrame:
    """Distinct delivered paid orders, revenue and AOV per customer state."""
    per_order = paid_delivered_orders(wh, "customer_id")
    # pre-aggregate per customer: the customer lookup then joins one row per customer
    per_customer = per_order.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("revenue").cast(TOTAL).alias("revenue")
    )
    states = wh["customers"].select("customer_id", "customer_state")
    return (
        per_customer.join(states, "customer_id")
        .groupBy("customer_state")
        .agg(F.sum("orders").alias("_orders"), F.sum("revenue").cast(TOTAL).alias("_revenue"))
        .select(
            "customer_state",
            F.col("_orders").cast("long").alias("order_count"),
            money_value("_revenue").alias("total_revenue"),
            money_avg("_revenue", "_orders").alias("avg_order_value"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("customer_state").asc_nulls_last())
    )
