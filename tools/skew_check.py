"""Reproduce the skew measurements of the README.

    python tools/skew_check.py [sf_dir] [share]

Derives a copy of ``events`` in which ``share`` (default 0.4) of the rows
belong to one user, then runs, with broadcasts off and partition coalescing
off so that every join and window shuffles:

* the plain per-user running-sum window vs ``running_total``;
* the plain profile join vs the salted one inside ``deviation_flags``.

For each, prints the largest and the total shuffle records read by one task
of the heaviest stage, from the Spark event log (no UI). Scratch data and
logs go to a new ``mktemp`` folder.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from odometrix.operators import deviation_flags, running_total  # noqa: E402
from odometrix.operators.profile import deviation_profile, with_profile  # noqa: E402
from tools.stage_report import stage_report  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    share = float(sys.argv[2]) if len(sys.argv) > 2 else 0.4
    work = tempfile.mkdtemp(prefix="run-skew-")
    runs = {}
    for label in ("window", "running_total", "plain_join", "salted_join"):
        log = os.path.join(work, "log", label)
        os.makedirs(log)
        spark = (
            SparkSession.builder.master("local[8]")
            .config("spark.ui.enabled", "false")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.autoBroadcastJoinThreshold", "-1")
            .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
            .config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.compress", "false")
            .config("spark.eventLog.dir", log)
            .getOrCreate()
        )
        spark.sparkContext.setLogLevel("ERROR")
        path = os.path.join(work, "events")
        if not os.path.exists(path):
            cut = int(round(share * 1000))
            src = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
            src.withColumn(
                "user_id",
                F.when(F.abs(F.xxhash64("event_id")) % 1000 < cut, F.lit(0)).otherwise(F.col("user_id")),
            ).write.parquet(path)
        ev = spark.read.parquet(path).select("event_id", "user_id", "ts", "value")
        if label == "window":
            w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(
                Window.unboundedPreceding, 0
            )
            df = ev.withColumn("t", F.sum("value").over(w))
        elif label == "running_total":
            df = running_total(ev, "user_id", "ts", "value", tiebreak="event_id", name="t")
        elif label == "plain_join":
            df = with_profile(ev, deviation_profile(ev, "user_id", ["value"]), "user_id", split_hot_keys=False)
        else:
            df = deviation_flags(ev, "user_id", "ts", {"value": "both"})
        df.write.format("noop").mode("overwrite").save()
        spark.stop()
        stages = [s for s in stage_report(log) if s["total_records"] > 1000]
        heavy = max(stages, key=lambda s: s["max_records"])
        runs[label] = (heavy["max_records"], heavy["total_records"], heavy["tasks"])
    for label, (mx, total, tasks) in runs.items():
        print(f"{label:14s} largest task {mx:8d} of {total:8d} records over {tasks} tasks")


if __name__ == "__main__":
    main()
