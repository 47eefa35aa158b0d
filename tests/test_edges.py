"""Edge cases of the operators' contracts."""

import datetime as dt

import pytest

from odometrix.operators import (
    apply_tag_rules,
    breakdowns_by_label,
    deviation_flags,
    event_count_by_key,
    last_per_period,
    repairs_vs_usage,
    top_n,
    usage_range_by_key,
)

T0 = dt.datetime(2024, 1, 1)


def test_multi_column_key(spark):
    dim = spark.createDataFrame([(1, "a", "x", "y"), (1, "b", "z", "w")], "k1 int, k2 string, p string, q string")
    log = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "k1 int, k2 string")
    got = {r["l"]: r["breakdown_count"] for r in breakdowns_by_label(dim, log, ["k1", "k2"], ["p", "q"], label_name="l").collect()}
    assert got == {"x y": 2, "z w": 1}
    cnt = event_count_by_key(log, ["k1", "k2"], count_name="n")
    assert sorted(tuple(r) for r in cnt.collect()) == [(1, "a", 2), (1, "b", 1), (2, "a", 1)]


def test_top_n_larger_than_data(spark):
    df = spark.createDataFrame([(2, "a"), (1, "b")], "n long, label string")
    assert top_n(df, "n", "label", 10).count() == 2
    assert top_n(df, "n", "label", 10, with_ties=True).count() == 2


def test_usage_range_ignores_null_measures(spark):
    df = spark.createDataFrame([("v", 5.0), ("v", None), ("v", 2.0), ("w", None)], "k string, m double")
    got = {r["k"]: tuple(r)[1:] for r in usage_range_by_key(df, "k", "m").collect()}
    assert got == {"v": (2.0, 5.0, 3.0), "w": (None, None, None)}


def test_repairs_keep_zero_and_null_keys(spark):
    log = spark.createDataFrame([("a", "Repair"), (None, "Repair")], "vehicle_id string, action_taken string")
    rd = spark.createDataFrame([("a", 1.0), ("a", 3.5), ("b", 2.0), (None, 9.0)], "vehicle_id string, mileage double")
    plain = sorted(tuple(r) for r in repairs_vs_usage(log, rd, "vehicle_id").collect())
    assert plain == [("a", 1, 2)]  # null keys never join
    keep = {tuple(r) for r in repairs_vs_usage(log, rd, "vehicle_id", keep_zero=True).collect()}
    # the null-key usage group has no repairs row to meet (0 repairs, 9 - 9 = 0)
    assert keep == {(None, 0, 0), ("a", 1, 2), ("b", 0, 0)}


def test_last_per_period_hour_and_string_timestamps(spark):
    df = spark.createDataFrame(
        [("v", "2024-01-01 05:10:00", 1.0), ("v", "2024-01-01 05:50:00", 2.0), ("v", "2024-01-01 06:01:00", 3.0)],
        "k string, ts string, x double",
    )
    got = sorted(tuple(r) for r in last_per_period(df, "k", "ts", ["x"], period="hour").collect())
    assert got == [("v", dt.datetime(2024, 1, 1, 5), 2.0), ("v", dt.datetime(2024, 1, 1, 6), 3.0)]
    with pytest.raises(ValueError):
        last_per_period(df, "k", "ts", ["x"], period="minute")


def test_tag_rules_need_a_rule(spark):
    with pytest.raises(ValueError):
        apply_tag_rules(spark.range(1), [])


def test_flags_keep_the_null_key_row_like_the_left_join(spark):
    rows = [("a", T0 + dt.timedelta(hours=i), 1.0) for i in range(3)] + [(None, T0, 5.0), (None, T0, 7.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, x double")
    out = deviation_flags(df, "k", "ts", {"x": "both"}).collect()
    # profile LEFT JOIN readings: three readings of 'a', and one row for the
    # null-key profile, which matches no reading
    assert len(out) == 4
    null_rows = [r for r in out if r["k"] is None]
    assert len(null_rows) == 1 and null_rows[0]["converted_timestamp"] is None and null_rows[0]["peak_x"] == 0


def test_flag_rule_validation():
    from odometrix.operators import FlagRule

    with pytest.raises(ValueError):
        FlagRule("x", "sideways")


def test_profile_join_with_map_column(spark):
    from odometrix.operators import deviation_profile, with_profile

    rows = [("hot" if i % 4 else f"k{i}", float(i), {"a": i}) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, x double, m map<string,int>")
    out = with_profile(df, deviation_profile(df, "k", ["x"]), "k")
    assert out.count() == 200
