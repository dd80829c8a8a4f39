"""Summarise the final (adaptive) plans of registered queries.

    python tools/plan_report.py [--sf DIR] [name ...] > PLANS.md

Each query is run once; then its final plan is read: base-table scans that ran, exchanges,
reused exchanges, broadcasts, join and aggregate kinds, windows, Python stages, and the
pushed filters and read schema of each scan.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

def summarise(text: str) -> dict:
    trees = re.findall(r"== Final Plan ==\n(.*?)\+- == Initial Plan ==", text, flags=re.S)
    if not trees:                                          # nothing adaptive in this plan
        trees = [text.split("\n\n(1)")[0]]
    lines = re.findall(r"(?m)^[^A-Za-z]*([A-Z]\w+(?: parquet)?)[^\n(]*\((\d+)\)", "\n".join(trees))
    ops = [name for name, _ in lines]
    numbers = {n for name, n in lines if name == "Scan parquet"}
    scans = []
    for n in sorted(numbers, key=int):
        body = re.search(rf"\({n}\) Scan parquet.*?\n(.*?)(?=\n\n\(|\Z)", text, flags=re.S)
        body = body.group(1) if body else ""
        loc = re.search(r"Location: \w+ \[file:([^\],]+)", body)
        pushed = re.search(r"PushedFilters: (\[.*?\])", body)
        schema = re.search(r"ReadSchema: (struct<.*?>)\n?", body)
        scans.append((os.path.basename(loc.group(1)) if loc else "?",
                      pushed.group(1) if pushed else "[]", schema.group(1) if schema else "?"))

    def kinds(suffix: str) -> str:
        return ", ".join(sorted({o for o in ops if o.endswith(suffix)})) or "-"

    return {"scans": sum(o == "Scan parquet" for o in ops),
            "shuffles": sum(o == "Exchange" for o in ops),
            "reused": sum(o == "ReusedExchange" for o in ops),
            "broadcasts": sum(o == "BroadcastExchange" for o in ops),
            "joins": kinds("Join"), "aggregates": kinds("Aggregate"),
            "windows": sum(o == "Window" for o in ops),
            "python": ", ".join(sorted({o for o in ops if "Python" in o or "Arrow" in o
                                        or "Pandas" in o})) or "-",
            "detail": scans}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from fundscope.plans import catalog
    from fundscope.session import get_spark
    spark = get_spark()
    names = args.names or [n for n in catalog.QUERIES if n not in catalog.SEARCHES]
    print(f"# Final plans at {args.sf}\n")
    print("Grid searches are left out (hundreds of fits each). Queries that run jobs while they "
          "are built show their last plan.\n")
    head = ["scans", "shuffles", "reused", "broadcasts", "joins", "aggregates", "windows", "python"]
    print("| query | " + " | ".join(head) + " |\n|" + "---|" * (len(head) + 1))
    details = []
    for n in names:
        df = catalog.QUERIES[n](spark, args.sf)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        found = summarise(buf.getvalue())
        print(f"| {n} | " + " | ".join(str(found[k]) for k in head) + " |")
        details.append((n, found["detail"]))
    print("\n## Scans (pushed filters, read schema)\n")
    for n, scans in details:
        for table, pushed, schema in scans:
            print(f"- `{n}` {table}: pushed {pushed}; reads `{schema}`")


if __name__ == "__main__":
    main()
