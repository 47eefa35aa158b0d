"""Passes over the fact table, counted as rows read in Spark's event log."""

import json
import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.01"

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from odometrix.plans.driver_tables import QUERIES
from odometrix.session import get_session
spark = get_session(master="local[4]", shuffle_partitions=4)
rows = {t: spark.read.parquet(f"{sys.argv[2]}/{t}.parquet").count() for t in ("events", "lineitem")}
print("FACT", rows["events"], rows["lineitem"])
for name in sys.argv[3].split(","):
    spark.sparkContext.setLocalProperty("odx.query", name)
    QUERIES[name](spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
spark.stop()
"""

MOST = {  # passes over the fact
    "deviation_flags": 2, "with_profile": 2, "engine_temp_flags": 2, "deviation_flags_multi": 2,
    "flagged_readings_with_tags": 3, "abnormalities_by_tag": 3, "running_total": 2, "clamped_running_total": 2,
}


@pytest.fixture(scope="module")
def rows_read(tmp_path_factory):
    log = tmp_path_factory.mktemp("events")
    env = dict(os.environ, ODX_EVENT_LOG_DIR=f"file://{log}")
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPO, SF, ",".join(MOST)], env=env, capture_output=True, text=True, timeout=600
    )
    assert "FACT" in out.stdout, out.stderr[-2000:]
    events, lineitem = map(int, out.stdout.split("FACT")[1].split()[:2])
    stage_of, read = {}, dict.fromkeys(MOST, 0)
    for folder, _, files in os.walk(log):
        for f in files:
            for line in open(os.path.join(folder, f), errors="replace"):
                if not line.startswith("{"):
                    continue
                e = json.loads(line)
                if e["Event"] == "SparkListenerStageSubmitted":
                    stage_of[e["Stage Info"]["Stage ID"]] = e.get("Properties", {}).get("odx.query")
                elif e["Event"] == "SparkListenerTaskEnd":
                    name = stage_of.get(e["Stage ID"])
                    if name:
                        read[name] += (e.get("Task Metrics") or {}).get("Input Metrics", {}).get("Records Read", 0)
    return {n: r / (lineitem if n.endswith("_multi") else events) for n, r in read.items()}


@pytest.mark.parametrize("name", MOST)
def test_passes_over_the_fact(rows_read, name):
    assert 0.9 < rows_read[name] <= MOST[name] + 0.01
