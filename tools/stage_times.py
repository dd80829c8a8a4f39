"""Summarise stage times from a Spark event log (no web UI needed).

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py <that folder> [--top 15]

Prints the slowest stages: id, tasks, wall seconds, shuffle read / write MB and
the stage name (the call site).
"""

from __future__ import annotations

import argparse
import glob
import json
import os


def stages(path: str):
    files = [p for p in glob.glob(os.path.join(path, "**", "*"), recursive=True)
             if os.path.isfile(p)] if os.path.isdir(path) else [path]
    for f in files:
        with open(f, encoding="utf-8") as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                yield {
                    "stage": info["Stage ID"],
                    "tasks": info["Number of Tasks"],
                    "sec": (end - start) / 1000 if start and end else 0.0,
                    "read_mb": (acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0)
                                + acc.get("internal.metrics.shuffle.read.localBytesRead", 0))
                    / 1e6,
                    "write_mb": acc.get("internal.metrics.shuffle.write.bytesWritten", 0) / 1e6,
                    "name": info.get("Stage Name", ""),
                }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("path")
    ap.add_argument("--top", type=int, default=15)
    args = ap.parse_args()
    rows = sorted(stages(args.path), key=lambda r: -r["sec"])
    print(f"{'stage':>6} {'tasks':>6} {'sec':>7} {'shuf_rd_MB':>10} {'shuf_wr_MB':>10}  name")
    for r in rows[:args.top]:
        print(f"{r['stage']:>6} {r['tasks']:>6} {r['sec']:>7.2f} {r['read_mb']:>10.2f} "
              f"{r['write_mb']:>10.2f}  {r['name'][:70]}")
    print(f"stages: {len(rows)}, total stage seconds: {sum(r['sec'] for r in rows):.1f}")


if __name__ == "__main__":
    main()
