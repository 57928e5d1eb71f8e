"""Declared schema of the nine marketplace tables.

One registry drives reading (CSV with an explicit StructType), loading
(select-by-name with casts) and the constraint checks (primary keys,
NOT NULL columns, foreign keys).  Types follow the warehouse DDL: strings
for ids and zip prefixes (leading zeros), int for counts, double for money
and measures, timestamp_ntz for every instant (no zone anywhere).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
D = T.DoubleType()
TS = T.TimestampNTZType()


@dataclass(frozen=True)
class TableSpec:
    name: str
    raw_file: str
    columns: tuple[tuple[str, T.DataType, bool], ...]  # (name, type, nullable)
    key: tuple[str, ...] = ()
    primary_key: bool = False  # key declared as PRIMARY KEY (vs natural key only)
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    derived: tuple[str, ...] = field(default=())  # columns added by the clean step
    free_text: bool = False  # quoted fields may span lines, so its files cannot be split

    @property
    def column_names(self) -> list[str]:
        return [c for c, _, _ in self.columns]

    @property
    def not_null(self) -> list[str]:
        return [c for c, _, n in self.columns if not n]

    def struct(self, include_derived: bool = True) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c, t, True)
                for c, t, _ in self.columns
                if include_derived or c not in self.derived
            ]
        )


# Raw file names of the source data set, and the table layout
# of the warehouse (names, types, keys, references) that results must match.
TABLES: dict[str, TableSpec] = {
    "product_category_translation": TableSpec(
        "product_category_translation",
        "product_category_name_translation.csv",
        (
            ("product_category_name", S, False),
            ("product_category_name_english", S, False),
        ),
        key=("product_category_name",),
        primary_key=True,
    ),
    "customers": TableSpec(
        "customers",
        "olist_customers_dataset.csv",
        (
            ("customer_id", S, False),
            ("customer_unique_id", S, False),
            ("customer_zip_code_prefix", S, False),
            ("customer_city", S, False),
            ("customer_state", S, False),
        ),
        key=("customer_id",),
        primary_key=True,
    ),
    "sellers": TableSpec(
        "sellers",
        "olist_sellers_dataset.csv",
        (
            ("seller_id", S, False),
            ("seller_zip_code_prefix", S, False),
            ("seller_city", S, False),
            ("seller_state", S, False),
        ),
        key=("seller_id",),
        primary_key=True,
    ),
    "geolocation": TableSpec(
        "geolocation",
        "olist_geolocation_dataset.csv",
        (
            ("geolocation_zip_code_prefix", S, False),
            ("geolocation_lat", D, True),
            ("geolocation_lng", D, True),
            ("geolocation_city", S, True),
            ("geolocation_state", S, True),
        ),
    ),
    "products": TableSpec(
        "products",
        "olist_products_dataset.csv",
        (
            ("product_id", S, False),
            ("product_category_name", S, True),
            ("product_category_name_english", S, True),
            ("product_name_lenght", I, True),
            ("product_description_lenght", I, True),
            ("product_photos_qty", I, True),
            ("product_weight_g", D, True),
            ("product_length_cm", D, True),
            ("product_height_cm", D, True),
            ("product_width_cm", D, True),
        ),
        key=("product_id",),
        primary_key=True,
        foreign_keys=(
            (("product_category_name",), "product_category_translation", ("product_category_name",)),
        ),
        derived=("product_category_name_english",),
    ),
    "orders": TableSpec(
        "orders",
        "olist_orders_dataset.csv",
        (
            ("order_id", S, False),
            ("customer_id", S, False),
            ("order_status", S, False),
            ("order_purchase_timestamp", TS, True),
            ("order_approved_at", TS, True),
            ("order_delivered_carrier_date", TS, True),
            ("order_delivered_customer_date", TS, True),
            ("order_estimated_delivery_date", TS, True),
            ("order_purchase_month", S, True),
            ("delivery_delay_days", I, True),
        ),
        key=("order_id",),
        primary_key=True,
        foreign_keys=((("customer_id",), "customers", ("customer_id",)),),
        derived=("order_purchase_month", "delivery_delay_days"),
    ),
    "order_items": TableSpec(
        "order_items",
        "olist_order_items_dataset.csv",
        (
            ("order_id", S, False),
            ("order_item_id", I, False),
            ("product_id", S, False),
            ("seller_id", S, False),
            ("shipping_limit_date", TS, True),
            ("price", D, False),
            ("freight_value", D, False),
        ),
        key=("order_id", "order_item_id"),
        primary_key=True,
        foreign_keys=(
            (("order_id",), "orders", ("order_id",)),
            (("product_id",), "products", ("product_id",)),
            (("seller_id",), "sellers", ("seller_id",)),
        ),
    ),
    "order_payments": TableSpec(
        "order_payments",
        "olist_order_payments_dataset.csv",
        (
            ("order_id", S, False),
            ("payment_sequential", I, False),
            ("payment_type", S, False),
            ("payment_installments", I, False),
            ("payment_value", D, False),
        ),
        key=("order_id", "payment_sequential"),
        primary_key=True,
        foreign_keys=((("order_id",), "orders", ("order_id",)),),
    ),
    "order_reviews": TableSpec(
        "order_reviews",
        "olist_order_reviews_dataset.csv",
        (
            ("review_id", S, False),
            ("order_id", S, False),
            ("review_score", I, False),
            ("review_comment_title", S, True),
            ("review_comment_message", S, True),
            ("review_creation_date", TS, True),
            ("review_answer_timestamp", TS, True),
        ),
        key=("review_id", "order_id"),
        primary_key=False,
        foreign_keys=((("order_id",), "orders", ("order_id",)),),
        free_text=True,
    ),
}

# Load order of the warehouse (reference tables first).
LOAD_ORDER = [
    "product_category_translation",
    "customers",
    "sellers",
    "geolocation",
    "products",
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
]

# Tables whose primary key the duplicate-key section of the quality report checks.
KEY_CHECKS = {name: spec.key for name, spec in TABLES.items() if spec.primary_key}

# The date column checked per table.
DATE_RANGE_CHECKS = {
    "orders": "order_purchase_timestamp",
    "order_reviews": "review_creation_date",
}
