import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from odometrix.operators import (
    FlagRule,
    deviation_flags,
    deviation_profile,
    engine_temp_flags,
    with_profile,
)
from odometrix.plans import fleet
from tests.fleet_fixtures import SENSOR_SCHEMA, sensor_row

T0 = dt.datetime(2024, 1, 1)


def series(spark, groups):
    """groups: {key: [values]} -> key, ts, x"""
    data = []
    for k, vals in groups.items():
        for i, v in enumerate(vals):
            data.append((k, T0 + dt.timedelta(hours=i), v))
    return spark.createDataFrame(data, "k string, ts timestamp, x double")


def flags_of(df, key="k"):
    return {(r[key], r["converted_timestamp"]): r for r in df.collect()}


def test_ten_readings_one_extreme_is_never_flagged(spark):
    df = series(spark, {"a": [10.0] * 9 + [1000.0]})
    out = deviation_flags(df, "k", "ts", {"x": "both"})
    assert sum(r["peak_x"] for r in out.collect()) == 0


def test_eleven_readings_ten_equal_one_extreme_is_flagged(spark):
    df = series(spark, {"a": [10.0] * 10 + [1000.0]})
    out = deviation_flags(df, "k", "ts", {"x": "both"}).collect()
    assert sum(r["peak_x"] for r in out) == 1
    assert [r["converted_timestamp"] for r in out if r["peak_x"]] == [T0 + dt.timedelta(hours=10)]


def test_single_reading_and_constant_key_give_no_flag(spark):
    df = series(spark, {"one": [5.0], "flat": [3.0] * 20})
    out = deviation_flags(df, "k", "ts", {"x": "both"})
    assert out.agg(F.sum("peak_x")).first()[0] == 0
    prof = {r["k"]: r for r in deviation_profile(df, "k", ["x"]).collect()}
    assert prof["one"]["std_x"] is None and prof["flat"]["std_x"] == 0.0


def test_sides(spark):
    df = series(spark, {"a": [10.0] * 10 + [-1000.0]})
    rules = [FlagRule("x", "high", "hi"), FlagRule("x", "low", "lo"), FlagRule("x", "both", "any")]
    out = deviation_flags(df, "k", "ts", rules).agg(F.sum("hi"), F.sum("lo"), F.sum("any")).first()
    assert tuple(out) == (0, 1, 1)


def test_null_and_nan_readings(spark):
    vals = [10.0] * 10 + [1000.0, None, float("nan")]
    df = series(spark, {"a": vals})
    out = deviation_flags(df, "k", "ts", {"x": "both"}).collect()
    by_ts = {r["converted_timestamp"]: r["peak_x"] for r in out}
    assert by_ts[T0 + dt.timedelta(hours=11)] == 0  # null reading
    assert by_ts[T0 + dt.timedelta(hours=12)] == 0  # NaN treated as null
    assert by_ts[T0 + dt.timedelta(hours=10)] == 1  # NaN did not poison the mean
    prof = deviation_profile(df, "k", ["x"]).first()
    assert prof["mean_x"] == sum(vals[:11]) / 11


def test_with_profile_columns_and_null_key_row(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, 3.0), (None, 3, 5.0), (None, 4, 7.0)], "k string, i int, x double"
    )
    prof = deviation_profile(df, "k", ["x"])
    out = with_profile(df, prof, "k")
    assert out.columns == ["k", "mean_x", "std_x", "i", "x"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    # profile LEFT JOIN readings: the null-key profile row matches nothing
    assert got == sorted([("a", 2.0, 2 ** 0.5, 1, 1.0), ("a", 2.0, 2 ** 0.5, 2, 3.0), (None, 6.0, 2 ** 0.5, None, None)], key=repr)


def test_join_form_equals_window_form_on_non_null_keys(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    joined = with_profile(ev, deviation_profile(ev, "user_id", ["value"]), "user_id")
    w = Window.partitionBy("user_id")
    windowed = ev.select(
        "user_id",
        F.avg("value").over(w).alias("mean_value"),
        F.stddev_samp("value").over(w).alias("std_value"),
        *[c for c in ev.columns if c != "user_id"],
    )
    cols = joined.columns
    diff = joined.select(*cols).exceptAll(windowed.select(*cols))
    assert joined.count() == windowed.count() == ev.count()
    # both forms aggregate the same doubles; allow last-bit differences only
    assert diff.count() == 0 or diff.join(windowed, "event_id").filter(
        F.abs(diff["mean_value"] - windowed["mean_value"]) > 1e-9
    ).count() == 0


def sensors(spark):
    data = [sensor_row("V00001", h, float(h), temp=85.0) for h in range(10)]
    data.append(sensor_row("V00001", 10, 10.0, temp=140.0, volt=9.5, tires=(15.0, 32.0, 32.0, 32.0)))
    data += [sensor_row("V00002", h, float(h)) for h in range(3)]
    return spark.createDataFrame(data, SENSOR_SCHEMA)


def test_gold_sensor_reading_peaks(spark):
    got = fleet.gold_sensor_reading_peaks(sensors(spark))
    assert got.columns == [
        "vehicle_id", "converted_timestamp", "peak_voltage", "peak_temp", "peak_pressure",
        "peak_fl_tire_pressure", "peak_fr_tire_pressure", "peak_rl_tire_pressure", "peak_rr_tire_pressure",
    ]
    assert {f.dataType.simpleString() for f in got.schema.fields[2:]} == {"int"}
    flagged = got.filter(F.col("peak_temp") == 1).collect()
    assert len(flagged) == 1 and flagged[0]["peak_voltage"] == 1 and flagged[0]["peak_fl_tire_pressure"] == 1
    assert flagged[0]["peak_pressure"] == 0
    assert got.count() == 14


def test_profile_columns_follow_reference_order(spark):
    prof = fleet.sensor_readings_mean_std(sensors(spark))
    assert prof.columns[:7] == [
        "vehicle_id", "mean_temp", "std_temp", "mean_voltage", "std_voltage", "mean_pressure", "std_pressure",
    ]
    assert prof.columns[-2:] == ["mean_rr_tire_pressure", "std_rr_tire_pressure"]


def test_engine_temp_flags_and_drilldown(spark):
    flags = fleet.gold_sensor_engine_temp_with_flags(sensors(spark))
    assert flags.columns == ["timestamp", "vehicle_id", "peak_flag"]
    assert flags.agg(F.sum("peak_flag")).first()[0] == 1
    drill = fleet.sensor_drilldown(sensors(spark))
    assert drill.columns == ["timestamp", "vehicle_id", "front_left_tire_pressure"]
    assert drill.count() == 11


def test_engine_temp_flags_string_timestamps(spark):
    df = spark.createDataFrame(
        [("V1", f"2024-01-01 {h:02d}:00:00", 80.0 if h < 11 else 150.0) for h in range(12)],
        "vehicle_id string, timestamp string, engine_temp double",
    )
    out = engine_temp_flags(df)
    assert out.schema["timestamp"].dataType.simpleString() == "timestamp"
    assert out.agg(F.sum("peak_flag")).first()[0] == 1


def test_readings_for_pushes_filter_to_both_scans(spark):
    from tools.plan_report import final_lines

    from odometrix.plans.driver_tables import q_readings_for

    q = q_readings_for(spark, "/root/testdata/sf0.01")
    assert q.count() == 81
    q.collect()
    plan = "\n".join(final_lines(q._jdf.queryExecution().executedPlan().toString()))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert len(scans) >= 2
    assert all("EqualTo(user_id,7)" in ln for ln in scans)  # every scan is filtered
    assert "stddev" not in plan  # unused profile columns are pruned


def skewed_events(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    return ev.withColumn("user_id", F.expr("CASE WHEN event_id % 5 < 2 THEN 0 ELSE user_id END"))


def test_salted_profile_join_equals_plain_join_on_skewed_keys(spark):
    from odometrix.operators._skew import COUNT as _N
    from odometrix.operators._skew import hot_keys

    ev = skewed_events(spark)
    prof = deviation_profile(ev, "user_id", ["value"])
    salted = with_profile(ev, prof, "user_id")
    plain = with_profile(ev, prof, "user_id", split_hot_keys=False)
    assert salted.count() == plain.count() == ev.count()
    assert salted.exceptAll(plain).count() == 0
    counts = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias(_N))
    hot = {r["user_id"]: r["_odx_salts"] for r in hot_keys(counts, ["user_id"], 8).collect()}
    # 40% of the rows: 0.4 * 8 partitions * 4 salts per partition -> 13 salts
    assert hot == {0: 13}


def test_hot_key_bound_and_uniform_keys(spark):
    from odometrix.operators._skew import COUNT as _N
    from odometrix.operators._skew import hot_keys

    uniform = spark.range(8000).select((F.col("id") % 100).alias("k"), F.lit(1).alias(_N))
    counts = uniform.groupBy("k").agg(F.sum(_N).alias(_N))
    assert hot_keys(counts, ["k"], 8).count() == 0
    # whatever the counts, no more keys than partitions can be hot
    heavy = spark.createDataFrame([(i, 1000 - i) for i in range(50)], f"k long, {_N} long")
    assert hot_keys(heavy, ["k"], 8).count() <= 8


def test_salted_join_is_planned_when_the_profile_is_not_broadcast(spark):
    ev = skewed_events(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = deviation_flags(ev, "user_id", "ts", {"value": "both"})
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert len(rows) == ev.count()
    assert "SortMergeJoin [user_id" in plan and "_odx_salt" in plan


def test_oil_pressure_is_one_sided(spark):
    # quirk U3: the gold peaks flag oil pressure only on the high side, so an
    # injected pressure drop is missed while a spike is caught
    base = [sensor_row("V1", h, float(h), oil=40.0) for h in range(11)]
    drop = base + [sensor_row("V1", 11, 11.0, oil=12.0)]
    spike = base + [sensor_row("V1", 11, 11.0, oil=95.0)]
    for rows, expected in ((drop, 0), (spike, 1)):
        df = spark.createDataFrame(rows, SENSOR_SCHEMA)
        got = fleet.gold_sensor_reading_peaks(df).agg(F.sum("peak_pressure")).first()[0]
        assert got == expected


def test_salted_join_with_several_hot_keys_and_nulls(spark):
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        u = rnd.random()
        k = "big" if u < 0.35 else "mid" if u < 0.55 else None if u < 0.6 else f"k{rnd.randint(0, 60)}"
        rows.append((k, T0 + dt.timedelta(seconds=i), rnd.random() * 100))
    df = spark.createDataFrame(rows, "k string, ts timestamp, x double")
    prof = deviation_profile(df, "k", ["x"])
    salted = with_profile(df, prof, "k")
    plain = with_profile(df, prof, "k", split_hot_keys=False)
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    # the null-key profile row is there once, with null reading columns
    nulls = salted.filter(F.col("k").isNull()).collect()
    assert len(nulls) == 1 and nulls[0]["ts"] is None
    flags = deviation_flags(df, "k", "ts", {"x": "both"}, k=1.5)
    plain_flags = deviation_flags(df, "k", "ts", {"x": "both"}, k=1.5, split_hot_keys=False)
    assert flags.exceptAll(plain_flags).count() == 0 and flags.count() == plain_flags.count()
