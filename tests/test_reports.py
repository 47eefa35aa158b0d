import datetime as dt

import pytest
from pyspark.sql import functions as F

from odometrix.operators import (
    abnormalities_by_tag,
    breakdown_logs,
    breakdowns_by_label,
    event_count_by_key,
    flagged_readings_with_tags,
    top_n,
    usage_correlation,
    usage_range_by_key,
)
from odometrix.plans import fleet
from tests.fleet_fixtures import SENSOR_SCHEMA, logs, meta, sensor_row


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_breakdowns_by_make_model(spark):
    got = fleet.gold_breakdowns_by_make_model(meta(spark), logs(spark))
    assert got.columns == ["breakdown_count", "vehicle_make_model"]
    # V00001: two reactive logs, V00002: one -> Audi AE24 = 3; the null make is
    # one null-labelled group; V00005 (no logs) and V00006 (planned only)
    # are absent; V00009 has no metadata row.
    assert rows(got) == sorted([(3, "Audi AE24"), (1, "Toyota Pilaris"), (1, None)], key=repr)


def test_breakdowns_dimension_filter(spark):
    got = fleet.gold_breakdowns_by_make_model(
        meta(spark), logs(spark), where=F.col("vehicle_type") == "Van"
    )
    assert rows(got) == [(1, "Toyota Pilaris")]


def test_breakdowns_match_row_level_join_with_duplicate_dimension_keys(spark):
    dim = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "x")], "k int, p string, q string")
    log = spark.createDataFrame([(1, "R"), (1, "R"), (2, "R"), (2, "N"), (3, "R")], "k int, f string")
    got = breakdowns_by_label(dim, log, "k", ["p", "q"], log_filter=F.col("f") == "R", label_name="l")
    ref = (
        dim.join(log, "k").filter(F.col("f") == "R")
        .groupBy(F.concat("p", F.lit(" "), "q").alias("l")).agg(F.count("*").alias("breakdown_count"))
    )
    assert rows(got, "l", "breakdown_count") == rows(ref, "l", "breakdown_count")


def test_top_n_and_ties(spark):
    df = spark.createDataFrame(
        [(5, "a"), (3, "b"), (3, "c"), (3, "d"), (1, "e")], "n long, label string"
    )
    assert [tuple(r) for r in top_n(df, "n", "label", 2).collect()] == [(5, "a"), (3, "b")]
    ties = top_n(df, "n", "label", 2, with_ties=True)
    assert [tuple(r) for r in ties.collect()] == [(5, "a"), (3, "b"), (3, "c"), (3, "d")]


def sensors(spark):
    data = [
        sensor_row("V00001", 0, 3.0),
        sensor_row("V00001", 1, 10.9),
        sensor_row("V00002", 0, 100.0),
        sensor_row("V00002", 1, 150.5),
        sensor_row("V00003", 0, 7.0),
        sensor_row("V00003", 5, 9.0),
        sensor_row("V00005", 0, 1.0),  # no repairs at all
        sensor_row("V00005", 1, 2.0),
    ]
    return spark.createDataFrame(data, SENSOR_SCHEMA)


def test_repairs_vs_mileage(spark):
    got = fleet.gold_vehicle_logs_by_mile_traveled(logs(spark), sensors(spark))
    assert got.columns == ["vehicle_id", "num_of_repairs", "mileage_diff"]
    assert dict(got.schema.fields and [(f.name, f.dataType.simpleString()) for f in got.schema.fields]) == {
        "vehicle_id": "string", "num_of_repairs": "bigint", "mileage_diff": "int"
    }
    # Inspection is not a repair; 3.0 -> 10.9 truncates to 7; V00005 has no
    # repair and V00004/V00009 have no readings.
    assert rows(got) == [("V00001", 2, 7), ("V00002", 1, 50), ("V00003", 1, 2)]


def test_repairs_vs_mileage_keep_zero(spark):
    got = fleet.gold_vehicle_logs_by_mile_traveled(logs(spark), sensors(spark), keep_zero=True)
    assert rows(got) == [("V00001", 2, 7), ("V00002", 1, 50), ("V00003", 1, 2), ("V00005", 0, 1)]


def test_usage_range_and_event_count(spark):
    rng = usage_range_by_key(sensors(spark), "vehicle_id", "mileage")
    assert rng.columns == ["vehicle_id", "min_mileage", "max_mileage", "mileage_diff"]
    assert rows(rng.filter("vehicle_id = 'V00001'")) == [("V00001", 3.0, 10.9, 10.9 - 3.0)]
    cnt = event_count_by_key(logs(spark), "vehicle_id", where=F.col("type") == "Reactive")
    assert dict(rows(cnt)) == {"V00001": 2, "V00002": 1, "V00003": 1, "V00004": 1, "V00009": 1}


def test_correlation(spark):
    got = fleet.mileage_repairs_correlation(logs(spark), sensors(spark)).first()["corr"]
    x, y = [2, 1, 1], [10.9 - 3.0, 50.5, 2.0]
    ref = spark.createDataFrame(list(zip(map(float, x), y)), "x double, y double").select(F.corr("x", "y")).first()[0]
    assert got == pytest.approx(ref)
    const = spark.createDataFrame([(1, 2.0), (1, 3.0)], "x long, y double")
    assert usage_correlation(const, "x", "y").first()["corr"] is None
    one = spark.createDataFrame([(1, 2.0)], "x long, y double")
    assert usage_correlation(one, "x", "y").first()["corr"] is None


H = dt.datetime(2024, 3, 1)


def env_with_risk(spark):
    return spark.createDataFrame(
        [
            (H, "Snow Storm", "high"),
            (H + dt.timedelta(hours=1), "Windy Rain", "medium"),
            (H + dt.timedelta(hours=2), None, None),
        ],
        "timestamp timestamp, climate_tag string, climate_risk string",
    )


@pytest.mark.parametrize("flag_type,one", [("int", 1), ("string", "1"), ("boolean", True)])
def test_abnormalities_by_climate_accepts_any_flag_type(spark, flag_type, one):
    zero = {"int": 0, "string": "0", "boolean": False}[flag_type]
    flags = spark.createDataFrame(
        [
            (H, "V00001", one),
            (H, "V00002", one),
            (H, "V00003", zero),
            (H + dt.timedelta(hours=1), "V00001", one),
            (H + dt.timedelta(hours=2), "V00001", one),  # untagged hour
            (H + dt.timedelta(days=5), "V00001", one),  # no weather that day
        ],
        f"timestamp timestamp, vehicle_id string, peak_flag {flag_type}",
    )
    got = fleet.gold_engine_abnormalities_by_climate(env_with_risk(spark), flags)
    assert rows(got, "climate_tag", "num_of_abnormalities") == [("Snow Storm", 2), ("Windy Rain", 1)]
    detail = fleet.engine_temp_with_environmental_data(env_with_risk(spark), flags)
    assert detail.columns == ["timestamp", "climate_tag", "climate_risk", "vehicle_id", "peak_flag"]
    # null tag kept at row level, dropped in the count; day 5 has no weather
    assert detail.count() == 4
    assert detail.filter(F.col("climate_tag").isNull()).count() == 1


def test_abnormalities_join_on_the_hour(spark):
    flags = spark.createDataFrame(
        [(H + dt.timedelta(minutes=20), "V00001", 1)],
        "timestamp timestamp, vehicle_id string, peak_flag int",
    )
    got = fleet.gold_engine_abnormalities_by_climate(env_with_risk(spark), flags)
    assert rows(got) == [("Snow Storm", 1)]


def test_abnormalities_count_equals_row_level_join_with_duplicate_hours(spark):
    tags = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "h int, climate_tag string")
    flags = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 0), (3, 1)], "h int, peak_flag int")
    got = abnormalities_by_tag(tags, flags, "h")
    assert rows(got) == [("a", 4), ("b", 1)]
    detail = flagged_readings_with_tags(tags.withColumn("climate_risk", F.lit("r")), flags.withColumn("vehicle_id", F.lit("v")), "h")
    assert detail.count() == 6


def test_top_n_with_ties_keeps_nulls(spark):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("c", None), ("d", None)], "k string, v int")
    def got(n):
        return [r.k for r in top_n(df, "v", "k", n, with_ties=True).collect()]

    assert got(2) == ["a", "b"] and got(3) == got(4) == got(9) == ["a", "b", "c", "d"]


def test_breakdown_logs_are_the_rows_behind_the_counts(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, make string")
    log = spark.createDataFrame([(1, "R", 5), (1, "P", 6), (3, "R", 7), (9, "R", 8)], "k int, type string, cost int")
    rows = breakdown_logs(dim, log, "k", log_filter=F.col("type") == "R")
    assert rows.columns == ["k", "make", "type", "cost"]
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, "x", "R", 5), (3, None, "R", 7)]
