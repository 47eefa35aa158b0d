import json
import os

import pytest

from odometrix.streaming import land_sensor_stream
from tests.test_sources import reading


def drop(root, name, rows):
    with open(os.path.join(root, name), "w") as fh:
        json.dump(rows, fh, indent=4)


def test_sensor_stream_lands_each_file_once(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    silver = os.path.join(tmp_dir, "silver")
    ckpt = os.path.join(tmp_dir, "ckpt")
    drop(raw, "V00001_2024-03-01.json", [reading("V00001", "2024-03-01 05:00:00", 100, 1.0), reading("V00001", "2024-03-01 06:00:00", 90.0, 2.0)])
    drop(raw, "V00002_2024-03-01.json", [reading("V00002", "2024-03-01 07:00:00", 80.0, 3.0)])
    land_sensor_stream(spark, raw, silver, ckpt).awaitTermination()
    assert spark.read.parquet(silver).count() == 3

    drop(raw, "V00001_2024-03-02.json", [reading("V00001", "2024-03-02 05:00:00", 70.0, 4.0)])
    land_sensor_stream(spark, raw, silver, ckpt).awaitTermination()
    out = spark.read.parquet(silver)
    assert out.count() == 4  # old files are not landed twice
    assert sorted(r["mileage"] for r in out.collect()) == [1.0, 2.0, 3.0, 4.0]
    assert {str(r["date"]) for r in out.select("date").distinct().collect()} == {"2024-03-01", "2024-03-02"}
    assert "front_left_tire_pressure" in out.columns


def test_sensor_stream_continuous_mode(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    drop(raw, "V00003_2024-03-01.json", [reading("V00003", "2024-03-01 09:00:00", 60.0, 7.0)])
    q = land_sensor_stream(
        spark, raw, os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "ckpt"),
        available_now=False, interval="1 second", max_files_per_trigger=1,
        query_name="odx_sensor_test",
    )
    try:
        q.processAllAvailable()
        drop(raw, "V00003_2024-03-02.json", [reading("V00003", "2024-03-02 09:00:00", 50.0, 8.0)])
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(os.path.join(tmp_dir, "silver")).count() == 2


def test_second_target_needs_and_gets_its_own_checkpoint(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    drop(raw, "V00001_2024-03-01.json", [reading("V00001", "2024-03-01 05:00:00", 100, 1.0)])
    a, b, ckpt = (os.path.join(tmp_dir, n) for n in ("a", "b", "ckpt"))
    land_sensor_stream(spark, raw, a, ckpt).awaitTermination()
    with pytest.raises(ValueError, match="belongs to"):
        land_sensor_stream(spark, raw, b, ckpt)
    land_sensor_stream(spark, raw, b, os.path.join(tmp_dir, "ckpt_b")).awaitTermination()
    assert spark.read.parquet(a).count() == spark.read.parquet(b).count() == 1


def test_fresh_checkpoint_for_a_written_target_is_refused(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    drop(raw, "V00001_2024-03-01.json", [reading("V00001", "2024-03-01 05:00:00", 100, 1.0)])
    silver = os.path.join(tmp_dir, "silver")
    land_sensor_stream(spark, raw, silver, os.path.join(tmp_dir, "one")).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        land_sensor_stream(spark, raw, silver, os.path.join(tmp_dir, "two"))
