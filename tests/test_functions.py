import datetime as dt
import math

from pyspark.sql import functions as F

from odometrix.functions import (
    clamp_min,
    flag_is_set,
    format_id,
    hour_of,
    make_label,
    nan_to_null,
    parse_date,
    parse_timestamp,
    round_half_even,
    safe_corr,
    timestamp_text,
    trunc_int,
)


def test_make_label_is_null_if_any_part_is_null(spark):
    df = spark.createDataFrame([("Audi", "AE24"), (None, "S900"), ("Audi", None)], "make string, model string")
    got = [r[0] for r in df.select(make_label("make", "model")).collect()]
    assert got == ["Audi AE24", None, None]


def test_trunc_int_truncates_toward_zero(spark):
    df = spark.createDataFrame([(7.9,), (-7.9,), (7.5,), (-7.5,)], "x double")
    assert [r[0] for r in df.select(trunc_int("x")).collect()] == [7, -7, 7, -7]


def test_flag_is_set_accepts_int_string_and_boolean(spark):
    ints = spark.createDataFrame([(1,), (0,), (None,)], "f int")
    strs = spark.createDataFrame([("1",), ("0",), (" true ",), ("x",), (None,)], "f string")
    bools = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert [r[0] for r in ints.select(flag_is_set(ints, "f")).collect()] == [True, False, False]
    assert [r[0] for r in strs.select(flag_is_set(strs, "f")).collect()] == [True, False, True, False, False]
    assert [r[0] for r in bools.select(flag_is_set(bools, "f")).collect()] == [True, False, False]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(nan_to_null("x")).collect()] == [1.0, None, None]


def test_round_half_even_matches_python_round(spark):
    df = spark.createDataFrame([(85000.0,), (75000.0,), (2.5,)], "x double")
    got = [r[0] for r in df.select(round_half_even("x", -4)).collect()]
    assert got[:2] == [round(85000, -4), round(75000, -4)]
    assert df.select(round_half_even("x", 0)).collect()[2][0] == round(2.5)


def test_clamp_min(spark):
    df = spark.createDataFrame([(-3.0,), (4.0,), (None,)], "x double")
    assert [r[0] for r in df.select(clamp_min("x")).collect()] == [0.0, 4.0, None]


def test_ids_and_text(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3, 4, 5))], "n int, t timestamp")
    row = df.select(format_id("V", "n"), format_id("D_", "n"), timestamp_text("t")).first()
    assert tuple(row) == ("V00001", "D_00001", "2024-01-02 03:04:05")


def test_parse_timestamp_and_date_give_null_for_bad_text(spark):
    df = spark.createDataFrame([("2024-01-02 03:00:00", "2024-01-02"), ("garbage", "2024-13-45")], "t string, d string")
    rows = df.select(parse_timestamp("t").alias("t"), parse_date("d").alias("d")).collect()
    assert rows[0]["t"] == dt.datetime(2024, 1, 2, 3, 0) and rows[0]["d"] == dt.date(2024, 1, 2)
    assert rows[1]["t"] is None and rows[1]["d"] is None


def test_hour_of_keeps_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 59, 1),)], "t timestamp_ntz")
    out = df.select(hour_of(df, "t").alias("h"))
    assert out.schema["h"].dataType.simpleString() == "timestamp_ntz"
    assert out.first()["h"] == dt.datetime(2024, 1, 1, 5, 0)


def test_safe_corr_guards_constant_and_single_row(spark):
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "x double, y double")
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    lin = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "x double, y double")
    assert const.select(safe_corr("x", "y")).first()[0] is None
    assert one.select(safe_corr("x", "y")).first()[0] is None
    got = lin.select(safe_corr("x", "y")).first()[0]
    ref = lin.select(F.corr("x", "y")).first()[0]
    assert math.isclose(got, ref, rel_tol=1e-12)


def test_ntz_truncation_ignores_session_zone(spark):
    from odometrix.functions import truncate_time

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        # 02:30 on 2024-03-10 does not exist in Los Angeles (DST starts)
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 5),)], "t timestamp_ntz")
        row = df.select(
            truncate_time(df, "t", "hour").alias("h"),
            truncate_time(df, "t", "day").alias("d"),
            truncate_time(df, "t", "week").alias("w"),
            truncate_time(df, "t", "month").alias("m"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert row["h"] == dt.datetime(2024, 3, 10, 2)
    assert row["d"] == dt.datetime(2024, 3, 10)
    assert row["w"] == dt.datetime(2024, 3, 4)
    assert row["m"] == dt.datetime(2024, 3, 1)


def test_planned_partitions(spark):
    from odometrix.session import planned_partitions

    assert planned_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "64")
    try:
        assert planned_partitions(spark) == 64
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
