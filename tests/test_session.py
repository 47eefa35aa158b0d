"""The session takes what the submission names and fills in only the rest."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from odometrix.session import get_session
s = get_session(master="local[8]", shuffle_partitions=8)
print("GOT", s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"), s.conf.get("spark.sql.session.timeZone"))
assert get_session(master="local[5]").sparkContext.master == s.sparkContext.master
"""


def run(args: str) -> str:
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS=f"{args} --conf spark.ui.enabled=false pyspark-shell")
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=300)
    assert "GOT" in out.stdout, out.stderr[-2000:]
    return out.stdout


def test_submission_wins():
    got = run("--master local[2] --conf spark.sql.shuffle.partitions=2000 --conf spark.sql.session.timeZone=Asia/Tokyo")
    assert "GOT local[2] 2000 Asia/Tokyo" in got


def test_defaults_fill_the_rest():
    assert "GOT local[8] 8 UTC" in run("")
