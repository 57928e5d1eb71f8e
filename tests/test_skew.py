"""Hot keys: one value holding a third of all rows must not land in one task."""

from __future__ import annotations

import re
from datetime import datetime as dt

from pyspark.sql import functions as F

from souk.operators.ranks import _numbered
from souk.plans import cohort, sales
from tests.fixture_tables import raw_fixture
from souk.operators.clean import transform_all


def test_range_numbering_spreads_a_hot_key(spark):
    n = 6000
    df = spark.range(n).select(
        F.format_string("id%06d", "id").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("key"),
    )
    pos = _numbered(df, ["key", "id"], 8)
    sizes = [r["count"] for r in pos.groupBy("_pid").count().collect()]
    assert sum(sizes) == n
    assert max(sizes) < 2.5 * n / 8  # the 2000 rows sharing key 7.0 are split by id


def test_hot_person_reaches_the_cohort_window_once_per_month(spark):
    raw = raw_fixture(spark)
    base = raw["orders"].where(F.col("order_id") == "o1")
    # 600 more delivered orders of customer c1 spread over three months
    extra = spark.range(600).select(
        F.format_string("h%04d", "id").alias("order_id"),
        F.lit("c1").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.make_timestamp_ntz(F.lit(2018), (F.col("id") % 3 + 1).cast("int"), F.lit(5), F.lit(0), F.lit(0), F.lit(0)).alias(
            "order_purchase_timestamp"
        ),
    )
    for c in base.columns[4:]:
        extra = extra.withColumn(c, F.lit(None).cast(base.schema[c].dataType))
    raw = dict(raw, orders=raw["orders"].unionByName(extra))
    wh = transform_all(raw)
    pm = cohort.person_months(wh).where(F.col("customer_unique_id") == "p1")
    assert pm.count() == 4  # Dec 2017 + Jan, Feb, Mar 2018: one row per month, not 602
    m = {(str(r.cohort_month)[:7], r.months_since_first): r.active_customers
         for r in cohort.cohort_retention_matrix(wh).collect()}
    assert m[("2017-12", 0)] == 1 and m[("2017-12", 3)] == 1


def test_per_order_revenue_is_combined_before_the_join(spark):
    import contextlib
    import io

    wh = transform_all(raw_fixture(spark))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        sales.monthly_revenue_trend(wh).explain()
    plan = buf.getvalue()
    # the payments side is aggregated (partial_sum) below the join with orders
    joins = [i for i in (plan.find("BroadcastHashJoin"), plan.find("SortMergeJoin")) if i >= 0]
    below = plan[min(joins):] if joins else ""
    assert re.search(r"partial_sum\([^\n]*payment_value", below)


def test_hot_order_is_spread_over_tasks(spark):
    raw = raw_fixture(spark)
    one = raw["order_items"].where(F.col("order_id") == "o1").limit(1)
    many = spark.range(600).select(F.col("id").cast("int").alias("n")).crossJoin(one)
    many = many.withColumn("order_item_id", F.col("n") + 100).withColumn("product_id", F.format_string("x%04d", "n")).drop("n")
    wh = transform_all(dict(raw, order_items=raw["order_items"].unionByName(many.select(*raw["order_items"].columns))))
    dealt = sales.salted_lines(wh).repartition(16, "order_id", "_salt").where(F.col("order_id") == "o1")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < sum(sizes) / 3
    plain = sales.category_revenue_all(transform_all(raw)).collect()
    assert sum(r.line_items for r in sales.category_revenue_all(wh).collect()) == sum(r.line_items for r in plain) + 600
