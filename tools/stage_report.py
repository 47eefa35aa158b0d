"""Per-stage times and task skew from a Spark event log (no UI needed).

    ODX_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_report.py <that dir>

For each completed stage: task count, wall time, and the largest and total
shuffle records read per task -- a largest task far above total/tasks is a
hot key or a hot block. Event logs must be uncompressed
(``odometrix.session`` sets that when ``ODX_EVENT_LOG_DIR`` is given).
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def stage_report(log_dir: str) -> list[dict]:
    files = [
        p
        for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
        if os.path.isfile(p) and os.path.basename(p).startswith(("events", "local-", "app-"))
    ]
    records = defaultdict(list)
    stages = {}
    for path in files:
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerTaskEnd":
                    metrics = e.get("Task Metrics") or {}
                    read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    records[e["Stage ID"]].append(read)
                elif ev == "SparkListenerStageCompleted":
                    info = e["Stage Info"]
                    stages[info["Stage ID"]] = {
                        "stage": info["Stage ID"],
                        "name": info["Stage Name"][:50],
                        "tasks": info["Number of Tasks"],
                        "ms": info.get("Completion Time", 0) - info.get("Submission Time", 0),
                    }
    out = []
    for sid, st in sorted(stages.items()):
        reads = records.get(sid, [0])
        out.append({**st, "max_records": max(reads), "total_records": sum(reads)})
    return out


def main() -> None:
    for row in stage_report(sys.argv[1]):
        print(
            f"stage {row['stage']:4d} tasks={row['tasks']:4d} {row['ms']:7d} ms "
            f"max_records={row['max_records']:9d} total_records={row['total_records']:10d}  {row['name']}"
        )


if __name__ == "__main__":
    main()
