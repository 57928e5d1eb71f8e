"""Command line: the two batch jobs and the quality report.

    python -m souk load   RAW_DIR WAREHOUSE_DIR [--lenient]
    python -m souk export WAREHOUSE_DIR MARTS_DIR [--mart NAME ...]
    python -m souk report WAREHOUSE_DIR
    python -m souk stats  WAREHOUSE_DIR

On a cluster, submit with spark-submit and set spark.checkpoint.dir to a
shared folder.
"""

from __future__ import annotations

import argparse
import logging
import sys

from souk.plans import pipeline
from souk.session import build_session
from souk.sources import warehouse


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="souk")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load", help="extract the raw CSVs, clean, write the warehouse, check it")
    p.add_argument("raw_dir")
    p.add_argument("warehouse_dir")
    p.add_argument("--lenient", action="store_true", help="load even if a declared constraint is violated")
    p = sub.add_parser("export", help="write every mart as parquet")
    p.add_argument("warehouse_dir")
    p.add_argument("marts_dir")
    p.add_argument("--mart", action="append", help="only these marts (repeatable)")
    p = sub.add_parser("report", help="print the data-quality report of a warehouse")
    p.add_argument("warehouse_dir")
    p = sub.add_parser("stats", help="late delivery vs review score; instalments vs review score")
    p.add_argument("warehouse_dir")
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    spark = build_session(app_name=f"souk-{args.cmd}")
    try:
        if args.cmd == "load":
            return pipeline.run_pipeline(spark, args.raw_dir, args.warehouse_dir, strict=not args.lenient)
        version = next(iter(warehouse.versions(spark, args.warehouse_dir)), None)
        wh = warehouse.read_tables(spark, args.warehouse_dir, version)
        if args.cmd == "export":
            pipeline.export_marts(wh, args.marts_dir, args.mart, version=version)
        elif args.cmd == "stats":
            from souk.plans import stats

            for title, df in (
                ("descriptives", stats.group_descriptives(wh)),
                ("mann-whitney U (late vs on time)", stats.mann_whitney_p(wh)),
                ("welch t", stats.welch_p(wh)),
                ("rank-biserial effect", stats.effect_size(wh)),
                ("spearman (instalments, score)", stats.spearman_p(wh)),
                ("mean score by instalments", stats.mean_score_by_installments(wh)),
            ):
                print(f"== {title}")
                df.show(df.count(), truncate=False)
        else:
            for name, df in pipeline.quality_report(wh).items():
                print(f"== {name}")
                df.show(df.count(), truncate=False)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
