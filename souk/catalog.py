"""All registered queries (spark, sf_dir) -> DataFrame and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from souk.oracle import ORACLES
from souk.plans.registry import RAW_BUILDERS, all_builders
from souk.sources import warehouse
from souk.sources.driver import raw_tables

Query = Callable[[SparkSession, str], DataFrame]


def _on_clean(builder) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return builder(warehouse.from_driver(spark, sf_dir))

    run.__doc__ = builder.__doc__
    return run


def _on_raw(builder) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return builder(raw_tables(spark, sf_dir))

    run.__doc__ = builder.__doc__
    return run


def all_queries() -> dict[str, Query]:
    out = {key: _on_clean(b) for key, b in all_builders().items()}
    out.update({key: _on_raw(b) for key, b in RAW_BUILDERS.items()})
    return out


def all_oracles() -> dict[str, str]:
    keys = set(all_queries())
    return {k: v for k, v in ORACLES.items() if k in keys}
