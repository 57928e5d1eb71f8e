"""Batch jobs: load the warehouse (extract -> clean -> write -> check) and
export the marts (every named result set -> ``<name>/`` parquet).

Independent writes are submitted from a small thread pool so Spark can run
them as concurrent jobs; each write is executed by the executors, results
are never collected.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from souk.jobs import run_concurrently
from souk.operators import quality
from souk.operators.clean import transform_all
from souk.plans import explore, rfm
from souk.plans.base import FACTS, order_facts
from souk.plans.registry import MARTS, SUITES
from souk.sources import warehouse
from souk.sources.csv_source import MissingSourceError, extract_all
from souk.sources.schemas import LOAD_ORDER

log = logging.getLogger("souk")


def write_counted(df: DataFrame, path: str, name: str) -> tuple[str, int, int]:
    """Overwrite path with df as parquet; rows counted while writing (observe)."""
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return name, obs.get["rows"], len(df.columns)


def _counted(clean: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
    """Clean tables that count, while they are written, what the cleaning found: rows of every table,
    products without an English name (of those with a category), orders without a delivery delay."""
    notes = {
        "products": F.count_if(F.col("product_category_name").isNotNull() & F.col("product_category_name_english").isNull()).alias("untranslated"),
        "orders": F.count_if(F.col("delivery_delay_days").isNull()).alias("without_delay"),
    }
    seen = {t: Observation(f"load-{t}") for t in clean}
    return {
        t: df.observe(seen[t], F.count(F.lit(1)).alias("rows"), *([notes[t]] if t in notes else [])) for t, df in clean.items()
    }, seen


def load_warehouse(raw: dict[str, DataFrame], out_dir: str, strict: bool = True, parallelism: int = 8) -> dict[str, DataFrame]:
    """S4/S5 + C10: clean the raw tables and (re)create every warehouse table.

    The tables are written to a new version folder of ``out_dir`` and checked
    there; only then does one rename of the manifest put them, all nine at
    once, in the place of the old ones.  A load that fails at any point before
    (strict: also by a violated constraint) leaves the old tables as they were.
    """
    spark = raw[LOAD_ORDER[0]].sparkSession
    before = {t: Observation(f"raw-{t}") for t in LOAD_ORDER}
    counted = {t: raw[t].observe(before[t], F.count(F.lit(1)).alias("rows")) for t in LOAD_ORDER}
    clean, after = _counted(warehouse.conform_all(transform_all(counted)))
    version = warehouse.new_version()
    try:
        warehouse.write_tables(clean, f"{out_dir}/{version}", parallelism)
        for t in LOAD_ORDER:
            found = after[t].get
            removed = before[t].get["rows"] - found["rows"] if t != "product_category_translation" else None
            more = {k: v for k, v in found.items() if k != "rows"}
            log.info("cleaned %-30s %10d rows, removed duplicates: %s %s", t, found["rows"], "-" if removed is None else removed, more or "")
        if strict:
            quality.enforce_constraints(warehouse.read_tables(spark, out_dir, version))
        warehouse.publish(spark, out_dir, version)
    except BaseException:
        warehouse.discard(spark, out_dir, version)
        raise
    return warehouse.read_tables(spark, out_dir, version)


def load_bucketed_warehouse(
    raw: dict[str, DataFrame], database: str, buckets: int | None, strict: bool = True, parallelism: int = 8
) -> dict[str, DataFrame]:
    """Load job writing catalog tables; ``buckets`` lays the order-keyed tables out by order_id.

    With buckets the order tables are hash partitioned by order_id once,
    before the dedupe; that single shuffle also lays out the buckets.  A
    bucket is read by one task, so pass ``buckets=None`` for data where one
    order may hold a large share of all lines: the tables are then written
    unbucketed, scans split by size and partial aggregation absorbs a hot
    order.  The layout is the caller's choice and never changes with the data.

    The tables are written to a database of their own and checked there; one
    change of the named database's properties then makes them its current
    version.  A load that fails before leaves the old version as it was.
    """
    clean = warehouse.conform_all(transform_all(raw, order_partitions=buckets))
    spark = raw[LOAD_ORDER[0]].sparkSession
    version = f"{database}_{uuid.uuid4().hex}"
    try:
        warehouse.save_catalog_tables(clean, version, buckets, parallelism=parallelism, prepartitioned=bool(buckets))
        if strict:
            quality.enforce_constraints(warehouse.read_catalog_tables(spark, version))
        warehouse.publish_catalog(spark, database, version)
    except BaseException:
        spark.sql(f"DROP DATABASE IF EXISTS {version} CASCADE")
        raise
    return warehouse.read_catalog_tables(spark, version)


def quality_report(wh) -> dict[str, DataFrame]:
    """Q1–Q6 as DataFrames (lazy)."""
    return {
        "row_counts": explore.table_row_counts(wh),
        "null_percent": quality.null_percent(wh),
        "duplicate_keys": quality.duplicate_key_groups(wh),
        "date_ranges": quality.date_ranges(wh),
        "orphan_orders": quality.orphan_orders(wh),
        "constraints": quality.declared_constraints(wh),
    }


def run_pipeline(spark: SparkSession, raw_dir: str, out_dir: str, strict: bool = True) -> int:
    """Extract the raw CSVs, clean, check, load, report.  Returns 0, or 1 when sources are missing."""
    try:
        raw = extract_all(spark, raw_dir)
    except MissingSourceError as exc:
        log.error("cannot run the pipeline, raw data not found: %s", exc)
        return 1
    wh = load_warehouse(raw, out_dir, strict=strict)
    for name, df in quality_report(wh).items():
        for row in df.collect():  # each report is a handful of rows
            log.info("%s: %s", name, row.asDict())
    return 0


#: The folder of an export that notes finished marts: a file per mart with warehouse version, rows and columns.
#: Its name starts with a full stop, which Spark's readers take for no data.
JOURNAL = ".journal"


def _note(out_dir: str, name: str) -> str:
    return f"{out_dir}/{JOURNAL}/{name.strip('_')}.txt"


def _noted(spark: SparkSession, out_dir: str, name: str, version: str | None) -> tuple[str, int, int] | None:
    """(name, rows, columns) of a mart that was written whole from this version of the warehouse."""
    if version is None:
        return None
    lines = warehouse.read_lines(spark, _note(out_dir, name), 3)
    return (name, int(lines[1]), int(lines[2])) if len(lines) == 3 and lines[0] == version else None


def _write_noted(spark: SparkSession, df: DataFrame, out_dir: str, name: str, version: str | None) -> tuple[str, int, int]:
    """Write a mart; its note goes before the old data does, and comes back once the new is whole."""
    note = _note(out_dir, name)
    warehouse.remove(spark, note)
    written = write_counted(df, f"{out_dir}/{name}", name)
    if version is not None:
        warehouse.write_text(spark, note, "".join(f"{x}\n" for x in (version, *written[1:])))
    return written


def export_marts(
    wh, out_dir: str, names: Iterable[str] | None = None, parallelism: int = 8, version: str | None = None
) -> list[tuple[str, int, int]]:
    """Write each named mart to ``out_dir/<name>`` and report (name, rows, columns).

    The per-order facts that most marts read, and the RFM scoring shared by the
    two RFM marts, are computed once per export.  With the ``version`` of the
    warehouse given, every finished mart is noted, and an export that starts
    again after a fault writes only the marts not yet noted for that version.
    """
    spark = next(iter(wh.values())).sparkSession
    names = list(names or [n for suite in sorted(SUITES) for n in SUITES[suite]])
    unknown = [n for n in names if n not in MARTS]
    if unknown:
        raise KeyError(f"unknown marts: {unknown}")
    done = {n: noted for n in names if (noted := _noted(spark, out_dir, n, version))}
    todo = [n for n in names if n not in done]
    wh = dict(wh)
    if FACTS not in wh and len(todo) > 1:
        # one row per delivered order, aggregated once for all marts
        if not _noted(spark, out_dir, f"_{FACTS}", version):
            _write_noted(spark, order_facts(wh), out_dir, f"_{FACTS}", version)
        wh[FACTS] = spark.read.parquet(f"{out_dir}/_{FACTS}")
    if {"rfm_customers", "rfm_segment_summary"} <= set(todo):
        wh[rfm.SCORED_KEY] = rfm.scored_customers(wh)
    written = run_concurrently([lambda n=n: _write_noted(spark, MARTS[n][1](wh), out_dir, n, version) for n in todo], parallelism)
    done |= {x[0]: x for x in written}
    results = [done[n] for n in names]
    for name, rows, cols in results:
        log.info("mart %-40s %8d rows, %2d cols%s", name, rows, cols, "" if name in todo else " (as noted)")
        first = preview(spark.read.parquet(f"{out_dir}/{name}"))
        log.info("first rows:\n%s", first.to_string(index=False))
    return results


def load_mart(spark: SparkSession, out_dir: str, name: str, cache: bool = False) -> DataFrame:
    """Read a mart written by ``export_marts``; cached on request (the caller then unpersists it)."""
    df = spark.read.parquet(f"{out_dir}/{name}")
    return df.cache() if cache else df


def stored_marts(spark: SparkSession, out_dir: str, names: Iterable[str] | None = None, cache: bool = False) -> dict[str, DataFrame]:
    """S9 for every mart: name -> DataFrame of the stored mart.

    Pass the result to the view builders (``souk.plans.views``) to shape the
    stored marts, as the dashboard does, instead of recomputing them.
    """
    return {n: load_mart(spark, out_dir, n, cache) for n in (names or MARTS)}


def register_views(wh: dict[str, DataFrame]) -> list[str]:
    """Expose the warehouse tables to SQL and list what the catalog sees."""
    for name, df in wh.items():
        df.createOrReplaceTempView(name)
    spark = next(iter(wh.values())).sparkSession
    return sorted(t.name for t in spark.catalog.listTables() if t.isTemporary)


def preview(df: DataFrame, n: int = 3):
    """First rows of a result for a log line."""
    return df.limit(n).toPandas()
