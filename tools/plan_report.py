"""Summarise the physical plan of every mart on a loaded warehouse.

    python tools/plan_report.py [sf_dir] > PLANS.md

Loads the driver tables into the bucketed catalog warehouse (as bench.py
does), then for each mart prints the scans (columns read, pushed filters),
the exchanges by kind and the join strategies of the initial adaptive plan
(AQE may still turn a sort-merge join into a broadcast at run time).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from souk.operators import quality  # noqa: E402
from souk.plans.pipeline import load_bucketed_warehouse  # noqa: E402
from souk.plans.registry import MARTS  # noqa: E402
from souk.session import build_session  # noqa: E402
from souk.sources.driver import raw_tables  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _clean(text: str) -> str:
    return re.sub(r"#\d+L?", "", text)


def summarise(plan: str) -> dict:
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        cols = re.search(r"FileScan parquet \S*\[([^\]]*)\]", line)
        pushed = re.search(r"PushedFilters: \[(.*?)(\](, ReadSchema|$)|\.\.\.)", line)
        loc = re.search(r"Location: [^\[]*\[[^\]]*?([A-Za-z_]+)\]", line)
        scans.append(
            (
                loc.group(1) if loc else "?",
                _clean(cols.group(1)) if cols else "?",
                _clean(pushed.group(1)) if pushed else "",
            )
        )
    return {
        "scans": scans,
        "hash_exchanges": [_clean(k) for k in re.findall(r"Exchange hashpartitioning\(([^,]+)", plan)],
        "range_exchanges": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "bhj": len(re.findall(r"BroadcastHashJoin", plan)),
        "window_group_limit": "WindowGroupLimit" in plan,
        "checkpoint_reads": len(re.findall(r"Scan ExistingRDD", plan)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="souk-plans-")
    spark = build_session(
        "local[8]",
        shuffle_partitions=16,
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "w"),
            "spark.checkpoint.dir": os.path.join(scratch, "ck"),
        },
    )
    wh = load_bucketed_warehouse(raw_tables(spark, sf_dir), "plans_wh", buckets=16, strict=False)
    items = [(f"{mid} {name}", b) for name, (mid, b) in MARTS.items()]
    items.append(("Q6 declared_constraints", quality.declared_constraints))
    print("# Physical plans of the marts\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}`: warehouse loaded as in `bench.py` "
          "(order tables bucketed by `order_id`, 16 buckets), initial adaptive plans, "
          "`spark.sql.shuffle.partitions=16`.  Hash exchanges list their first key.\n")
    print("| query | scans: table [columns] {pushed filters} | hash exchanges | range | broadcast | SMJ / BHJ | notes |")
    print("|---|---|---|---|---|---|---|")
    for title, builder in items:
        s = summarise(plan_text(builder(wh)))
        scans = "<br>".join(f"{t} [{c}] {{{f}}}" if f else f"{t} [{c}]" for t, c, f in s["scans"])
        notes = []
        if s["window_group_limit"]:
            notes.append("WindowGroupLimit")
        if s["checkpoint_reads"]:
            notes.append(
                f"{s['checkpoint_reads']} checkpoint reads (the table scans run once, in the checkpoint job of the NTILE)"
            )
        if s["single_partition"]:
            notes.append(f"{s['single_partition']} SinglePartition exchange(s) (global aggregate of partials, or totals over grouped rows)")
        print(
            f"| {title} | {scans} | {', '.join(s['hash_exchanges']) or '–'} | {s['range_exchanges']} | "
            f"{s['broadcasts']} | {s['smj']} / {s['bhj']} | {'; '.join(notes)} |"
        )
    spark.stop()


if __name__ == "__main__":
    main()
