import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from odometrix.operators import flatten_tires, to_silver_environment, to_silver_maintenance, to_silver_sensor
from odometrix.schemas import RAW_ENVIRONMENT, RAW_MAINTENANCE
from odometrix.sources import (
    corrupt_sensor_records,
    hourly_spine,
    hourly_spine_for,
    read_sensor_json,
    write_once,
    write_sensor_json,
)


def reading(vid, ts, fuel, mileage, engine=85.0):
    return {
        "vehicle_id": vid,
        "timestamp": ts,
        "tire_pressure": {"front_left": 31.0, "front_right": 32.0, "rear_left": 33.0, "rear_right": 34.0},
        "engine_temp": engine,
        "oil_pressure": 40.0,
        "fuel_level": fuel,
        "battery_voltage": 13.1,
        "mileage": mileage,
    }


def write_drop(root):
    os.makedirs(root, exist_ok=True)
    files = {
        "V00001_2024-03-01.json": [
            reading("V00001", "2024-03-01 05:00:00", 100, 10.5),  # integer fuel after a refuel
            reading("V00001", "2024-03-01 06:00:00", 91.25, 20.0),
        ],
        "V00002_2024-03-01.json": [
            reading("V00002", "not a time", 80.0, 5.0),
        ],
    }
    for name, rows in files.items():
        with open(os.path.join(root, name), "w") as fh:
            json.dump(rows, fh, indent=4)  # one array over many lines
    return files


def test_read_sensor_json_and_silver(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw_sensor_data")
    write_drop(root)
    raw = read_sensor_json(spark, root, with_file_name=True)
    assert raw.count() == 3
    names = {r["source_file"] for r in raw.collect()}
    assert names == {"V00001_2024-03-01.json", "V00002_2024-03-01.json"}
    silver = to_silver_sensor(raw.drop("source_file"))
    assert silver.columns[:6] == [
        "vehicle_id", "timestamp", "front_left_tire_pressure", "front_right_tire_pressure",
        "rear_left_tire_pressure", "rear_right_tire_pressure",
    ]
    rows = {(r["vehicle_id"], r["mileage"]): r for r in silver.collect()}
    assert rows[("V00001", 10.5)]["fuel_level"] == 100.0
    assert rows[("V00001", 10.5)]["timestamp"] == dt.datetime(2024, 3, 1, 5)
    assert rows[("V00001", 10.5)]["rear_right_tire_pressure"] == 34.0
    assert rows[("V00002", 5.0)]["timestamp"] is None  # malformed: null, row kept


def test_flatten_tires_keeps_other_columns_in_place(spark):
    df = spark.createDataFrame(
        [("V1", (1.0, 2.0, 3.0, 4.0), 9.0)],
        "vehicle_id string, tire_pressure struct<front_left:double,front_right:double,rear_left:double,rear_right:double>, x double",
    )
    out = flatten_tires(df)
    assert out.columns == [
        "vehicle_id", "front_left_tire_pressure", "front_right_tire_pressure",
        "rear_left_tire_pressure", "rear_right_tire_pressure", "x",
    ]


def test_other_silver_tables(spark):
    m = spark.createDataFrame([("V1", "2024-03-02", "Planned", "Engine", "Routine check", "Inspection", 50.0), ("V1", "bad", "Reactive", "Tires", "x", "Repair", 1.0)], RAW_MAINTENANCE)
    got = [r["date"] for r in to_silver_maintenance(m).collect()]
    assert got == [dt.date(2024, 3, 2), None]
    e = spark.createDataFrame([("2024-03-01 01:00:00", 40.0, 10.0, 180.0, 0.5, 60.0)], RAW_ENVIRONMENT)
    assert to_silver_environment(e).first()["timestamp"] == dt.datetime(2024, 3, 1, 1)


def test_write_once_keeps_existing_data(spark, tmp_dir):
    path = os.path.join(tmp_dir, "once")
    write_once(spark.range(3), path)
    write_once(spark.range(10), path)
    assert spark.read.parquet(path).count() == 3


def test_write_sensor_json_layout_and_roundtrip(spark, tmp_dir):
    rows = [("V00001", dt.datetime(2024, 3, 1, h), float(h)) for h in range(5, 13)]
    rows += [("V00002", dt.datetime(2024, 3, 2, 7), 1.0)]
    df = spark.createDataFrame(rows, "vehicle_id string, timestamp timestamp, mileage double")
    path = os.path.join(tmp_dir, "sensor_json")
    write_sensor_json(df, path)
    assert os.path.isdir(os.path.join(path, "vehicle_id=V00001", "date=2024-03-01"))
    assert os.path.isdir(os.path.join(path, "vehicle_id=V00002", "date=2024-03-02"))
    back = spark.read.json(path)
    assert back.count() == 9
    assert set(back.columns) == {"timestamp", "mileage", "vehicle_id", "date"}
    stamps = {r["timestamp"] for r in back.select(F.col("timestamp").cast("string").alias("timestamp")).collect()}
    assert "2024-03-01 05:00:00" in stamps  # the raw writers' layout


def test_hourly_spine(spark):
    s = hourly_spine(spark, "2024-03-01 00:00:00", "2024-03-28 23:00:00")
    assert s.count() == 672
    assert s.schema["hour"].dataType.simpleString() == "timestamp_ntz"
    hours = sorted(r["hour"] for r in s.collect())
    assert hours[0] == dt.datetime(2024, 3, 1) and hours[-1] == dt.datetime(2024, 3, 28, 23)
    assert len(set(hours)) == 672


def test_hourly_spine_for_data(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 22, 15),), (dt.datetime(2024, 1, 2, 3, 59),), (None,)], "ts timestamp_ntz"
    )
    hours = sorted(r["hour"] for r in hourly_spine_for(df, "ts").collect())
    assert hours == [dt.datetime(2024, 1, 1, 22) + dt.timedelta(hours=i) for i in range(6)]


def test_vehicle_type_lookup(spark):
    from odometrix.sources import model_catalog, with_vehicle_type

    rows = [("V1", "Audi", "AE24"), ("V2", "Mercedes-Benz", "CX-14"), ("V3", "Audi", "Nope"), ("V4", "Toyota", "AE24")]
    df = spark.createDataFrame(rows, "vehicle_id string, make string, model string")
    got = {r["vehicle_id"]: r["vehicle_type"] for r in with_vehicle_type(df, model_catalog(spark)).collect()}
    assert got == {"V1": "Bus", "V2": "Van", "V3": None, "V4": None}
    assert model_catalog(spark).count() == 9
    # One model name under two makes does not double the row.
    both = spark.createDataFrame([("Audi", "AE24", "Bus"), ("Toyota", "AE24", "Van")], "make string, model string, vehicle_type string")
    assert with_vehicle_type(df, both).count() == 4


def test_truncated_sensor_file_never_becomes_nulls(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    write_drop(root)
    whole = json.dumps([reading("V00009", "2024-03-01 05:00:00", 1, 1.0), reading("V00009", "2024-03-01 06:00:00", 1, 2.0)], indent=4)
    with open(os.path.join(root, "V00009_2024-03-01.json"), "w") as fh:
        fh.write(whole[: len(whole) * 3 // 4])
    good = read_sensor_json(spark, root, on_corrupt="skip")
    assert good.filter("vehicle_id is null or vehicle_id = 'V00009'").count() == 0 and good.count() >= 3
    bad = corrupt_sensor_records(spark, root).collect()
    assert [r.source_file for r in bad] == ["V00009_2024-03-01.json"] and "V00009" in bad[0].record
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|malformed"):
        read_sensor_json(spark, root).collect()


def test_shift_time(spark):
    from odometrix.functions import shift_date, shift_time

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), dt.date(2024, 1, 1))], "t timestamp_ntz, d date")
    out = df.select(
        shift_time("t", weeks=1, days=2, hours=3).alias("t"),
        shift_time("t", days=1).alias("t1"),
        shift_date("d", weeks=4).alias("d"),
    )
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["timestamp_ntz", "timestamp_ntz", "date"]
    row = out.first()
    assert row["t"] == dt.datetime(2024, 1, 10, 8) and row["t1"] == dt.datetime(2024, 1, 2, 5)
    assert row["d"] == dt.date(2024, 1, 29)


def test_sensor_json_roundtrip_through_json_lines(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw_sensor_data")
    write_drop(root)
    silver_in = read_sensor_json(spark, root).filter(F.col("vehicle_id") == "V00001")
    out = os.path.join(tmp_dir, "lines")
    write_sensor_json(silver_in, out)
    back = read_sensor_json(spark, out, multi_line=False)
    assert back.count() == 2
    assert sorted(r["mileage"] for r in back.collect()) == [10.5, 20.0]
    assert {r["vehicle_id"] for r in back.collect()} == {"V00001"}  # from the path


def test_write_overwrite(spark, tmp_dir):
    from odometrix.sources import write_overwrite

    path = os.path.join(tmp_dir, "over")
    write_overwrite(spark.range(3), path)
    write_overwrite(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_write_once_keeps_an_empty_partitioned_dataset(spark, tmp_dir):
    path = os.path.join(tmp_dir, "none")
    days = spark.range(4).withColumn("day", F.col("id") % 2)
    assert write_once(days.limit(0), path, partition_by=["day"]) is True
    assert write_once(days, path, partition_by=["day"]) is False
    lines = os.path.join(tmp_dir, "lines")
    assert write_once(days, lines, fmt="json") is True and write_once(days, lines, fmt="json") is False


def test_load_table_accepts_paths_and_uris(spark, tmp_dir):
    from odometrix.sources import load_table

    assert load_table(spark, "/root/testdata/sf0.001", "region").count() == 5
    assert load_table(spark, "file:/root/testdata/sf0.001", "region").count() == 5
    assert load_table(spark, "file:///root/testdata/sf0.001/", "region").count() == 5
    spark.range(3).write.parquet(os.path.join(tmp_dir, "t"))  # a directory table
    assert load_table(spark, tmp_dir, "t").count() == 3


def test_register_tables_for_sql(spark):
    from odometrix.sources import register_tables

    frames = register_tables(spark, "/root/testdata/sf0.001", ["region", "nation"])
    assert set(frames) == {"region", "nation"}
    n = spark.sql(
        "SELECT count(*) FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"
    ).first()[0]
    assert n == 25


def indented(root, name, readings, tail=""):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w") as fh:
        json.dump(readings, fh, indent=4)
        fh.write(tail)


def test_indented_array_is_read_in_splits(spark, tmp_dir):
    from odometrix.sources import read_indented_array

    root = os.path.join(tmp_dir, "large")
    odd = 'quoted "}" and\n    }\n[x], {y}'  # what a record's text may hold
    rows = [reading(odd if i % 50 == 0 else f"V{i % 7:05d}", f"2024-03-01 {i % 24:02d}:00:00", i % 90, i / 2) for i in range(4000)]
    indented(root, "one.json", rows)
    whole = read_sensor_json(spark, root)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        split = read_indented_array(spark, root)
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 8
        assert split.schema == whole.schema
        assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_indented_array_edges(spark, tmp_dir):
    from odometrix.sources import read_indented_array

    root = os.path.join(tmp_dir, "edges")
    indented(root, "empty.json", [])
    indented(root, "one.json", [reading("V00001", "2024-03-01 05:00:00", 1, 2.0)], tail="\n")
    assert [r.vehicle_id for r in read_indented_array(spark, root).collect()] == ["V00001"]
    with open(os.path.join(root, "cut.json"), "w") as fh:
        fh.write(json.dumps([reading("V00002", "2024-03-01 05:00:00", 1, 2.0)] * 2, indent=4)[:-60])
    with pytest.raises(Exception, match="not a record of an indented array"):
        read_indented_array(spark, root).collect()
    left = read_indented_array(spark, root, on_corrupt="skip").collect()
    assert sorted(r.vehicle_id for r in left) == ["V00001", "V00002"]
