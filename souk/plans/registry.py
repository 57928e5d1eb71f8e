"""Registry of named result sets: name -> builder(tables) -> DataFrame.

Mart names are the file names the export job writes (``<name>.parquet``).
Query keys used by the test driver carry the survey id as prefix
(``M01_monthly_revenue_trend``).  Builders in ``CLEAN_BUILDERS`` take the
nine clean warehouse tables; builders in ``RAW_BUILDERS`` take the raw
tables as extracted (before trimming, de-duplication and derivations).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.exprs import strip
from souk.operators import clean, quality
from souk.plans import cohort, delivery, explore, kpis, payments, rfm, sales, stats, views
from souk.plans.base import Warehouse
from souk.sources.schemas import LOAD_ORDER

Builder = Callable[[Warehouse], DataFrame]

# mart name -> (id, builder)
MARTS: dict[str, tuple[str, Builder]] = {
    "monthly_revenue_trend": ("M01", sales.monthly_revenue_trend),
    "revenue_by_category": ("M02", sales.revenue_by_category),
    "revenue_by_state": ("M03", sales.revenue_by_state),
    "rfm_customers": ("M04", rfm.rfm_customers),
    "rfm_segment_summary": ("M05", rfm.rfm_segment_summary),
    "cohort_retention_matrix": ("M06", cohort.cohort_retention_matrix),
    "cohort_sizes": ("M07", cohort.cohort_sizes),
    "delivery_rate_overall": ("M08", delivery.delivery_rate_overall),
    "delivery_delay_by_state": ("M09", delivery.delivery_delay_by_state),
    "review_score_by_delivery": ("M10", delivery.review_score_by_delivery),
    "payment_type_mix": ("M11", payments.payment_type_mix),
    "installment_distribution": ("M12", payments.installment_distribution),
    "avg_payment_value_by_installments": ("M13", payments.avg_payment_value_by_installments),
    "credit_card_installments_by_category": ("M14", payments.credit_card_installments_by_category),
    "summary_kpis": ("M15", kpis.summary_kpis),
}

# The analysis suites: one named batch per subject, exported together.
SUITES: dict[str, list[str]] = {
    "cohort_retention": ["cohort_retention_matrix", "cohort_sizes"],
    "delivery_performance": ["delivery_rate_overall", "delivery_delay_by_state", "review_score_by_delivery"],
    "payment_behavior": [
        "payment_type_mix",
        "installment_distribution",
        "avg_payment_value_by_installments",
        "credit_card_installments_by_category",
    ],
    "rfm_segmentation": ["rfm_customers", "rfm_segment_summary"],
    "sales_overview": ["monthly_revenue_trend", "revenue_by_category", "revenue_by_state"],
    "summary": ["summary_kpis"],
}


def mart_queries() -> dict[str, Builder]:
    return {f"{mid}_{name}": b for name, (mid, b) in MARTS.items()}


CLEAN_BUILDERS: dict[str, Builder] = {
    # window / aggregation operators exercised on their own
    "W5_rfm_scores": rfm.rfm_scores,
    "W6_review_score_avg_rank": stats.review_score_ranks,
    "A9_having_min_payments_800": lambda wh: payments.credit_card_installments_by_category(wh, min_payments=800),
    # exploratory queries
    "E1_table_row_counts": explore.table_row_counts,
    "E2_missing_in_orders": explore.missing_in_orders,
    "E3_undelivered_status": explore.undelivered_status,
    "E4_missing_in_reviews": explore.missing_in_reviews,
    "E5_missing_in_products": explore.missing_in_products,
    "E6_status_funnel": explore.status_funnel,
    "E7_review_distribution": explore.review_distribution,
    "E8_top_categories_by_revenue": explore.top_categories_by_revenue,
    "E8_top_categories_by_volume": explore.top_categories_by_volume,
    "E9_top10_states_by_revenue": lambda wh: explore.top_states_by_revenue(wh, 10),
    "E9_top15_states_by_revenue": lambda wh: explore.top_states_by_revenue(wh, 15),
    # dashboard views
    "D1_kpi_row": views.kpi_row,
    "D2_monthly_trend_view": views.monthly_trend_view,
    "D3_top_category": views.top_category,
    "D3_top_state": views.top_state,
    "D3_state_revenue_bars": views.state_revenue_bars,
    "D4_segment_table": views.segment_table,
    "D4_top_segment": views.top_segment,
    "D5_retention_wide": views.retention_wide,
    "D6_month1_retention": views.month1_retention,
    "D7_late_vs_on_time": views.late_vs_on_time,
    "D8_worst_best_state": views.worst_best_state,
    "D9_dominant_payment": views.dominant_payment,
    "D10_single_installment_share": views.single_installment_share,
    "D11_most_installments_category": views.most_installments_category,
    # quality report
    "Q1_row_counts": explore.table_row_counts,
    "Q2_null_percent": quality.null_percent,
    "Q3_duplicate_keys": quality.duplicate_key_groups,
    "Q4_date_ranges": quality.date_ranges,
    "Q5_orphan_orders": quality.orphan_orders,
    "Q6_declared_constraints": quality.declared_constraints,
    # cleaning results
    "C4_translated_products": lambda wh: wh["products"].select(
        "product_id", "product_category_name", "product_category_name_english"
    ),
    "C4_untranslated_count": lambda wh: clean.untranslated_count(wh["products"]),
    "C5_category_translation": lambda wh: wh["product_category_translation"],
    "C6_delivery_delay": lambda wh: wh["orders"].select("order_id", "delivery_delay_days"),
    "C7_purchase_month": lambda wh: wh["orders"].select("order_id", "order_purchase_month"),
    # statistics
    "T1_late_review_sample": stats.late_review_sample,
    "T2_group_descriptives": stats.group_descriptives,
    "T3_mann_whitney_u": stats.mann_whitney,
    "T4_welch_t": stats.welch_t,
    "T5_rank_biserial": stats.rank_biserial,
    "T6_effect_size": stats.effect_size,
    "T7_installment_review_sample": stats.installment_review_sample,
    "T8_installment_review_describe": stats.installment_review_describe,
    "T9_spearman": stats.spearman,
    "T10_mean_score_by_installments": stats.mean_score_by_installments,
    "T11_score_histogram": stats.score_histogram,
    # the same tests with their p-values
    "T3p_mann_whitney_p": lambda wh: stats.rounded(stats.mann_whitney_p(wh)),
    "T3x_weekday_means_exact_p": lambda wh: stats.rounded(stats.weekday_means_p(wh)),
    "T4p_welch_p": lambda wh: stats.rounded(stats.welch_p(wh)),
    "T9p_spearman_p": lambda wh: stats.rounded(stats.spearman_p(wh)),
}


def dedupe_counts(raw: Warehouse) -> DataFrame:
    """Rows before/after de-duplication of every raw table (after trimming, as the load does)."""
    parts = [clean.dedupe_report(clean.trim_strings(raw[t]), t) for t in LOAD_ORDER]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def trim_counts(raw: Warehouse) -> DataFrame:
    """Per text column of every raw table, rows that trimming changes and the characters left."""
    parts = []
    for t in LOAD_ORDER:
        texts = [f.name for f in raw[t].schema.fields if f.dataType.simpleString() == "string"]
        if not texts:
            continue
        after = {c: strip(c) for c in texts}
        one = raw[t].agg(
            F.array(
                *(
                    F.struct(
                        F.lit(t).alias("table_name"),
                        F.lit(c).alias("column_name"),
                        F.count_if(F.col(c) != after[c]).alias("trimmed_rows"),
                        F.coalesce(F.sum(F.length(after[c])), F.lit(0)).cast("long").alias("characters_left"),
                    )
                    for c in texts
                )
            ).alias("rows")
        )
        parts.append(one.select(F.explode("rows").alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


RAW_BUILDERS: dict[str, Builder] = {
    "C1_trim_strings": trim_counts,
    "C2_dedupe_counts": dedupe_counts,
}


def all_builders() -> dict[str, Builder]:
    """Every builder over clean tables: marts first, then the other families."""
    out = dict(mart_queries())
    out.update(CLEAN_BUILDERS)
    return out
