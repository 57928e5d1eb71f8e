"""Cleaning and enrichment of the raw tables (trim, exact dedupe, category
translation, derived purchase month and delivery delay).

Everything is a lazy DataFrame transformation; the only shuffles are the
exact-row dedupe (hash aggregate on all columns, map-side combined) and the
translation completion (distinct categories, anti join).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.exprs import floor_days, strip, year_month


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip Unicode whitespace around every string column."""
    cols = [
        strip(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def dedupe(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (all columns)."""
    return df.dropDuplicates()


def dedupe_report(df: DataFrame, table: str) -> DataFrame:
    """One row (table_name, rows_before, rows_after, removed_rows).

    One pass: rows are grouped on all columns (map-side combined); the
    number of groups is the count after de-duplication, the sum of their
    sizes the count before.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("long").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).select(
        F.lit(table).alias("table_name"),
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("removed_rows"),
    )


def generic_clean(df: DataFrame) -> DataFrame:
    """Trim then dedupe (trim first, so rows equal after trimming collapse)."""
    return dedupe(trim_strings(df))


def complete_translation(translation: DataFrame, raw_products: DataFrame) -> DataFrame:
    """Append categories used by products but absent from the translation,
    with the source name as the English name."""
    used = (
        raw_products.select(strip("product_category_name").alias("product_category_name"))
        .where(F.col("product_category_name").isNotNull())
        .distinct()
    )
    missing = used.join(translation.select("product_category_name"), "product_category_name", "left_anti")
    return translation.select("product_category_name", "product_category_name_english").unionByName(
        missing.select(
            "product_category_name",
            F.col("product_category_name").alias("product_category_name_english"),
        )
    )


def translate_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """C4: attach the English category name, keeping the source name."""
    tr = translation.select("product_category_name", "product_category_name_english")
    base = products.drop("product_category_name_english")
    rest = [c for c in base.columns if c not in ("product_id", "product_category_name")]
    return base.join(tr, "product_category_name", "left").select(
        "product_id", "product_category_name", "product_category_name_english", *rest
    )


def untranslated_count(products: DataFrame) -> DataFrame:
    """C4 warning: products with a category but no English name."""
    return products.agg(
        F.count_if(
            F.col("product_category_name").isNotNull() & F.col("product_category_name_english").isNull()
        ).alias("untranslated_products")
    )


def derive_orders(orders: DataFrame) -> DataFrame:
    """C6 + C7: purchase month 'YYYY-MM' and whole-day delivery delay (floor)."""
    return orders.withColumn(
        "order_purchase_month", year_month("order_purchase_timestamp")
    ).withColumn(
        "delivery_delay_days",
        floor_days("order_estimated_delivery_date", "order_delivered_customer_date"),
    )


ORDER_KEYED = ("orders", "order_items", "order_payments", "order_reviews")


def transform_all(raw: Mapping[str, DataFrame], order_partitions: int | None = None) -> dict[str, DataFrame]:
    """The whole cleaning step, dict of raw tables -> dict of clean tables.

    ``order_partitions`` hash-partitions the order-keyed tables by order_id
    first: exact duplicates share their order_id, so the dedupe aggregate
    reuses that partitioning, and a bucketed write by order_id needs no
    further shuffle.
    """
    clean = generic_clean

    def keyed(name: str) -> DataFrame:
        df = raw[name]
        return df.repartition(order_partitions, "order_id") if order_partitions else df

    translation = complete_translation(clean(raw["product_category_translation"]), raw["products"])
    out = {
        "product_category_translation": translation,
        "products": translate_products(clean(raw["products"]), translation),
        "customers": clean(raw["customers"]),
        "sellers": clean(raw["sellers"]),
        "geolocation": clean(raw["geolocation"]),
        "orders": derive_orders(clean(keyed("orders"))),
        "order_items": clean(keyed("order_items")),
        "order_payments": clean(keyed("order_payments")),
        "order_reviews": clean(keyed("order_reviews")),
    }
    return out
