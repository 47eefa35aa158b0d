"""Daily partials and mergeable moments against full recomputes."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from odometrix.operators import DailyPartials, deviation_profile, merge_moments, moments, profile_of


def readings(spark, seed=1, n=900, base=1e9):
    """A small spread around a large mean, which naive sums of squares lose."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = None if rnd.random() < 0.05 else math.nan if rnd.random() < 0.02 else base + rnd.random()
        rows.append((i, rnd.choice([1, 1, 1, 2, 3, None]), f"2024-01-{rnd.randint(1, 9):02d}", v, rnd.choice("abc")))
    rows += [(n, 50, "2024-01-01", 5.0, "a"), (n + 1, 51, "2024-01-02", None, "b")]
    df = spark.createDataFrame(rows, "id long, k long, day string, v double, kind string").repartition(4)
    return df.withColumn("day", F.to_date("day"))


def as_dict(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def close(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-9)


def same_profile(got, want):
    got, want = as_dict(got), as_dict(want)
    assert got.keys() == want.keys()
    for k in got:
        assert all(close(x, y) for x, y in zip(got[k], want[k])), (k, got[k], want[k])


def test_merged_states_equal_the_full_profile(spark):
    df = readings(spark)
    states = moments(df, ["k", "day"], ["v"])
    want = deviation_profile(df, "k", ["v"])
    same_profile(profile_of(merge_moments(states, ["k"], ["v"]), ["k"], ["v"]), want)
    # In two steps: days to a kind of week, weeks to all.
    weeks = merge_moments(states.withColumn("week", F.day("day") % 3), ["k", "week"], ["v"])
    same_profile(profile_of(merge_moments(weeks, ["k"], ["v"]), ["k"], ["v"]), want)


@pytest.mark.parametrize("order", [(0, 1, 2, 0), (2, 1, 0, 2), (1, 1, 2, 0)])
def test_replays_in_any_order_give_the_full_report(spark, tmp_dir, order):
    df = readings(spark, base=3.0)
    merges = {"n": "sum", "low": "min", "high": "max", "v": "moments"}
    store = DailyPartials(spark, os.path.join(tmp_dir, "store"), ["k"], merges)

    def partials(rows):
        counts = rows.groupBy("k", "day").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        states = moments(rows, ["k", "day"], ["v"]).withColumnsRenamed({"k": "k2", "day": "day2"})
        return counts.join(states, counts.k.eqNullSafe(states.k2) & (counts.day == states.day2)).drop("k2", "day2")

    store.replace(partials(df.filter("kind = 'a'")))  # incomplete days
    for part in order:  # whole days, some of them twice
        store.replace(partials(df.filter(F.day("day") % 3 == part)))
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    got = store.merged()
    assert as_dict(got.select("k", "n", "low")) == as_dict(want.select("k", "n", "low"))
    same_profile(profile_of(got, ["k"], ["v"]), deviation_profile(df, "k", ["v"]))


def test_a_day_is_replaced_alone_and_may_become_empty(spark, tmp_dir):
    store = DailyPartials(spark, os.path.join(tmp_dir, "days"), ["k"], {"n": "sum"})
    rows = spark.createDataFrame([(1, "2024-01-01", 2), (1, "2024-01-02", 3), (1, None, 9)], "k long, day string, n long")
    store.replace(rows)
    first = os.path.join(tmp_dir, "days", "day=2024-01-01")
    kept = sorted(os.listdir(first))
    store.replace(rows.limit(0), days=["2024-01-02"])
    assert sorted(os.listdir(first)) == kept
    assert [tuple(r) for r in store.merged().collect()] == [(1, 2)]
    with pytest.raises(Exception, match="was not named"):
        store.replace(rows, days=["2024-01-01"])


def test_a_new_day_reads_one_day(spark, tmp_dir):
    source = os.path.join(tmp_dir, "readings")
    readings(spark).write.partitionBy("day").parquet(source)
    one = spark.read.parquet(source).filter("day = date'2024-01-03'")
    plan = moments(one, ["k", "day"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-03" in plan
