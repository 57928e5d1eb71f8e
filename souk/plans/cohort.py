"""Acquisition cohorts (M06 retention matrix, M07 cohort sizes).

The months in which a customer id, then a person, ordered are the set bits of a
bitmap put together by ``bit_or`` (map-side combined): one small row per person
however many orders there are.  The first month is the lowest bit, and the
person's cells are the set bits, so no distinct pairs and no window are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.exprs import month_trunc, pct, r2
from souk.plans.base import Warehouse, delivered_orders

#: Months in a word of a bitmap.
BITS = 62


def _month_of(index: Column) -> Column:
    """First instant of a month given as year * 12 + month - 1."""
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.floor(index / 12).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int"), F.lit(1), zero, zero, zero)


def month_bitmaps(wh: Warehouse) -> DataFrame:
    """customer_unique_id, months (ascending month numbers of delivered orders), undated (if an order has no date).

    The words of the bitmaps span the months between the first and the last order (one row, read first).
    """
    ts = "order_purchase_timestamp"
    orders = delivered_orders(wh, "customer_id", ts).select("customer_id", (F.year(ts) * 12 + F.month(ts) - 1).alias("month"))
    low, high = orders.agg(F.min("month"), F.max("month")).first()
    low, words = low or 0, 0 if low is None else (high - low) // BITS + 1
    at = F.col("month") - low
    word = lambda w: F.when(F.floor(at / BITS) == w, F.expr(f"shiftleft(1L, CAST((month - {low}) % {BITS} AS INT))"))
    joined = lambda: [F.bit_or(f"w{w}").alias(f"w{w}") for w in range(words)]
    months = orders.select("customer_id", F.isnull("month").alias("undated"), *[word(w).alias(f"w{w}") for w in range(words)])
    people = wh["customers"].select("customer_id", "customer_unique_id")
    person = months.groupBy("customer_id").agg(F.max("undated").alias("undated"), *joined()).join(people, "customer_id")
    person = person.groupBy("customer_unique_id").agg(F.max("undated").alias("undated"), *joined())
    bits = [f"transform(filter(sequence(0, {BITS - 1}), b -> getbit(coalesce(w{w}, 0L), b) = 1), b -> b + {low + w * BITS})" for w in range(words)]
    return person.select("customer_unique_id", F.expr(f"concat({', '.join(bits)})" if bits else "CAST(array() AS array<int>)").alias("months"), "undated")


def person_months(wh: Warehouse) -> DataFrame:
    """Distinct (customer_unique_id, order_month) of delivered orders that have a date."""
    return month_bitmaps(wh).select("customer_unique_id", F.explode("months").alias("month")).select("customer_unique_id", _month_of(F.col("month")).alias("order_month"))


def cohort_activity(wh: Warehouse) -> DataFrame:
    """customer_unique_id, cohort_month, months_since_first (NULL: orders without a date), one row per cell of a person."""
    first = F.get("months", F.lit(0))
    since = F.transform("months", lambda m: (m - first).cast("long"))
    since = F.when(F.col("undated"), F.concat(since, F.array(F.lit(None).cast("long")))).otherwise(since)
    return month_bitmaps(wh).select("customer_unique_id", _month_of(first).alias("cohort_month"), F.explode(since).alias("months_since_first"))


def cohort_retention_matrix(wh: Warehouse) -> DataFrame:
    """Active persons per (cohort, month offset) and share of the cohort."""
    cells = cohort_activity(wh).groupBy("cohort_month", "months_since_first").agg(
        F.count(F.lit(1)).alias("active_customers")
    )
    # the month-0 cell of each cohort is its size; cells has one row per
    # (cohort, offset), so this window sees at most a few hundred rows per
    # cohort and the orders are read once
    month0 = F.max(F.when(F.col("months_since_first") == 0, F.col("active_customers")))
    return (
        cells.withColumn("cohort_size", month0.over(Window.partitionBy("cohort_month")))
        .where(F.col("cohort_size").isNotNull())  # inner join semantics: cohorts with a month-0 cell
        .select(
            "cohort_month",
            "months_since_first",
            "active_customers",
            "cohort_size",
            r2(pct("active_customers", F.nullif(F.col("cohort_size"), F.lit(0)))).alias("retention_pct"),
        )
        .orderBy("cohort_month", "months_since_first")
    )


def cohort_sizes(wh: Warehouse) -> DataFrame:
    """Persons per acquisition month."""
    people = wh["customers"].select("customer_id", "customer_unique_id")
    first = (
        delivered_orders(wh, "customer_id", "order_purchase_timestamp")
        .groupBy("customer_id")
        .agg(F.min(month_trunc("order_purchase_timestamp")).alias("first_month"))
        .join(people, "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.min("first_month").alias("cohort_month"))
    )
    return (
        first.groupBy("cohort_month")
        .agg(F.count(F.lit(1)).alias("cohort_size"))
        .orderBy(F.col("cohort_month").asc_nulls_last())
    )
