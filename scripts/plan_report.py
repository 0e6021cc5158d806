"""Summarise the physical plans of registered queries (explain("formatted")).

Usage: python scripts/plan_report.py [sf_dir] [name ...] > docs/PLANS.md
Per query: exchanges (shuffles), join strategies, aggregate kinds, and each
Parquet scan with the columns it reads and the filters pushed into it.
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = ["monthly_observed", "excess_label", "stage_deaths", "stage_cases", "fact_deaths",
           "dedup_keep_first", "weekly_to_monthly", "threshold_sweep", "star_observed"]


def summarise(plan: str) -> tuple[collections.Counter, list[str]]:
    ops = collections.Counter()
    head = plan.split("\n\n")[0]
    for line in head.splitlines():
        m = re.search(r"([A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)*) \(\d+\)", line)
        if m:
            name = m.group(1)
            for key in ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
                        "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window", "Sort", "Expand"):
                if name.startswith(key):
                    ops[key] += 1
                    break
    scans = []
    for block in re.findall(r"\(\d+\) Scan parquet[^\n]*\n(.*?)(?:\n\n|\Z)", plan, flags=re.S):
        loc = re.search(r"Location: \w+ \[(.*?)\]", block)
        schema = re.search(r"ReadSchema: (.*)", block)
        pushed = re.search(r"PushedFilters: (.*)", block)
        table = os.path.basename(loc.group(1)) if loc else "?"
        scans.append(f"{table}: reads {schema.group(1) if schema else '?'}; pushed {pushed.group(1) if pushed else '[]'}")
    return ops, scans


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if not os.path.isdir(a)] or DEFAULT
    import io
    from contextlib import redirect_stdout

    from vitals.queries import load_all
    from vitals.session import get_session
    spark = get_session("local[8]", 16, extra={"spark.ui.showConsoleProgress": "false"})
    qs = load_all()
    print(f"# Physical plans ({os.path.basename(sf)}, generated by scripts/plan_report.py)\n")
    for n in names:
        buf = io.StringIO()
        with redirect_stdout(buf):
            qs[n](spark, sf).explain("formatted")
        ops, scans = summarise(buf.getvalue())
        print(f"## {n}\n")
        print("operators: " + ", ".join(f"{k}×{v}" for k, v in sorted(ops.items())))
        print()
        for s in scans:
            print(f"* {s}")
        print()


if __name__ == "__main__":
    main()
