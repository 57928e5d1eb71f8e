"""Adapter from the driver's star-schema parquet tables to the nine raw tables.

The marketplace pipeline expects nine raw tables (see ``schemas.TABLES``).
The test driver ships TPC-H-like tables instead; this module derives the
nine raw tables from them with plain DataFrame operations, lazily, with
the padding and the duplicate rows that raw files bring.  The same mapping
is written in SQL in ``souk.oracle.PRELUDE``.

Integer keys of the driver tables are kept as bigint (cheaper to hash and
shuffle than text); every builder is agnostic to the key type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the mapping (driver code -> marketplace value).
ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_TYPE = {"A": "credit_card", "N": "boleto", "R": "voucher"}
ESTIMATE_AFTER = "INTERVAL '1080 12' DAY TO HOUR"  # estimated delivery = purchase + 1080 d 12 h
APPROVAL_AFTER = "INTERVAL 6 HOURS"
REVIEW_AFTER = "INTERVAL 1081 DAYS"
ANSWER_AFTER = "INTERVAL 30 HOURS"

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _lookup(c: str, mapping: dict[str, str], default: str):
    expr = None
    for code, value in mapping.items():
        expr = (F.when(F.col(c) == code, value) if expr is None else expr.when(F.col(c) == code, value))
    return expr.otherwise(default)


def read_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in DRIVER_TABLES}


def _numbered_lines(li: DataFrame) -> DataFrame:
    """Line items with a per-order item number 1..n.

    ``l_linenumber`` is not unique per order in the driver data, so the
    number is a row number over a total order of the line's columns.  Bound:
    one task numbers the lines of an order, of which the driver's generator
    makes a handful; the source's own files carry the number.
    """
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return li.withColumn("item_no", F.row_number().over(w))


def _as_delivered(df: DataFrame, number, texts: tuple[str, ...] = ()) -> DataFrame:
    """Rows as raw files bring them: by the row's number some rows come twice
    (last digit 3 or 7) and some texts are padded (last digit 0 or 5, and the
    second copy of a 7, which is a duplicate only after trimming)."""
    digit = F.pmod(number, F.lit(10))
    copies = F.when(digit.isin(3, 7), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    df = df.withColumns({"_digit": digit, "_copy": F.explode(copies)})
    padded = F.col("_digit").isin(0, 5) | ((F.col("_digit") == 7) & (F.col("_copy") == 1))
    for c in texts:
        df = df.withColumn(c, F.when(padded, F.concat(F.lit("  "), F.col(c), F.lit("\t"))).otherwise(F.col(c)))
    return df.drop("_digit", "_copy")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine raw marketplace tables (no derived columns yet), all lazy."""
    d = read_driver(spark, sf_dir)
    li, o, c, s, p, n = d["lineitem"], d["orders"], d["customer"], d["supplier"], d["part"], d["nation"]

    ship = li.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    orders = o.join(ship, o["o_orderkey"] == ship["l_orderkey"], "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _lookup("o_orderstatus", ORDER_STATUS, "unavailable").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.expr(APPROVAL_AFTER)).alias(
            "order_approved_at"
        ),
        F.col("first_ship").alias("order_delivered_carrier_date"),
        F.col("last_ship").alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr(ESTIMATE_AFTER)).alias("order_estimated_delivery_date"),
    )

    nation = n.select("n_nationkey", "n_name")
    customers = c.join(nation, c["c_nationkey"] == nation["n_nationkey"], "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.lower("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )
    sellers = s.join(nation, s["s_nationkey"] == nation["n_nationkey"], "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.lower("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )
    geolocation = c.join(nation, c["c_nationkey"] == nation["n_nationkey"], "left").select(
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / F.lit(1000.0)).alias("geolocation_lat"),
        (F.pmod(F.col("c_custkey"), F.lit(997)).cast("double") / F.lit(-10.0)).alias("geolocation_lng"),
        F.lower("c_mktsegment").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )
    products = p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_type").alias("product_description_lenght"),
        (F.pmod(F.col("p_size"), F.lit(5)) + 1).alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        F.col("p_size").cast("double").alias("product_length_cm"),
        (F.col("p_size") / F.lit(2.0)).alias("product_height_cm"),
        (F.col("p_size") / F.lit(4.0)).alias("product_width_cm"),
    )
    # The raw translation file is incomplete on purpose: brands whose number
    # is a multiple of 3 have no English name, so the completion step runs.
    brand_no = F.expr("try_cast(substring_index(p_brand, '#', -1) AS INT)")
    translation = (
        p.select("p_brand")
        .distinct()
        .where(F.pmod(brand_no, F.lit(3)) != 0)
        .select(
            F.col("p_brand").alias("product_category_name"),
            F.lower(F.regexp_replace("p_brand", "#", "_")).alias("product_category_name_english"),
        )
    )

    lines = _numbered_lines(li)
    order_items = lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("item_no").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )
    order_payments = lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("item_no").alias("payment_sequential"),
        _lookup("l_returnflag", PAYMENT_TYPE, "not_defined").alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )
    score = F.substring("o_orderpriority", 1, 1).cast("int")
    order_reviews = o.select(
        F.concat(F.lit("rv"), F.col("o_orderkey").cast("string")).alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        score.alias("review_score"),
        F.when(score <= 2, F.col("o_orderpriority")).alias("review_comment_title"),
        F.when(score <= 3, F.concat(F.lit("priority "), F.col("o_orderpriority"))).alias(
            "review_comment_message"
        ),
        (F.col("o_orderdate") + F.expr(REVIEW_AFTER)).alias("review_creation_date"),
        (F.col("o_orderdate") + F.expr(REVIEW_AFTER) + F.expr(ANSWER_AFTER)).alias(
            "review_answer_timestamp"
        ),
    )
    number_of_review = F.substring("review_id", 3, 18).cast("long")
    return {
        "product_category_translation": _as_delivered(
            translation, F.expr("CAST(substring_index(product_category_name, '#', -1) AS INT)"), ("product_category_name_english",)
        ),
        "customers": _as_delivered(customers, F.col("customer_id"), ("customer_unique_id", "customer_city")),
        "sellers": _as_delivered(sellers, F.col("seller_id"), ("seller_city",)),
        "geolocation": geolocation,  # repeats of its own: several customers of one place
        "products": _as_delivered(products, F.col("product_id"), ("product_category_name",)),
        "orders": _as_delivered(orders, F.col("order_id"), ("order_status",)),
        "order_items": _as_delivered(order_items, F.col("order_id")),
        "order_payments": _as_delivered(order_payments, F.col("order_id"), ("payment_type",)),
        "order_reviews": _as_delivered(order_reviews, number_of_review, ("review_comment_title", "review_comment_message")),
    }
