"""Carry, neighbour differences and as-of join against sequential loops."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from odometrix.operators import (
    asof_join,
    distance_travelled,
    missing_periods,
    opening_values,
    previous_values,
    with_position,
)

T0 = dt.datetime(2024, 1, 1)
METHODS = [{"method": "window"}, {}, {"num_blocks": 9}, {"method": "split", "num_blocks": 5}]


def make_rows(seed, n=1500, days=60):
    """(id, key, ts, value): a hot key, null and missing values, ties, null keys
    and times, keys with long gaps."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        u = rnd.random()
        key = 1 if u < 0.4 else None if u < 0.45 else rnd.randint(2, 30)
        span = 20 if key and key % 3 else days
        ts = None if rnd.random() < 0.01 else T0 + dt.timedelta(hours=rnd.randint(0, 24 * span))
        if key == 7 and ts:
            ts = ts.replace(month=1 + 2 * (i % 2))
        rows.append((i, key, ts, None if rnd.random() < 0.15 else rnd.randint(0, 100)))
    return rows


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r[1], []).append(r)
    for rs in out.values():
        rs.sort(key=lambda r: (r[2] is not None, r[2] or T0, r[0]))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, k long, ts timestamp, v long").repartition(4)


@pytest.mark.parametrize("options", METHODS)
@pytest.mark.parametrize("skip", [False, True])
def test_previous_values(spark, options, skip):
    rows = make_rows(3)
    got = previous_values(frame(spark, rows), "k", "ts", {"p": "v", "q": "id"}, tiebreak="id", skip_nulls=skip, **options)
    assert got.columns == ["id", "k", "ts", "v", "p", "q"]
    want = {}
    for rs in groups(rows).values():
        last = before = None
        for r in rs:
            want[r[0]] = (last, before[0] if before else None)
            before = r
            last = r[3] if not skip or r[3] is not None else last
    assert {r.id: (r.p, r.q) for r in got.collect()} == want


@pytest.mark.parametrize("options", METHODS)
def test_opening_values_carry_over_gaps(spark, options):
    rows = make_rows(5)
    got = opening_values(frame(spark, rows), "k", "ts", ["v"], tiebreak="id", **options)
    want = []
    for key, rs in groups(rows).items():
        rs = [r for r in rs if r[2] is not None]
        value, day = None, rs[0][2].date()
        while day <= rs[-1][2].date():
            mine = [r for r in rs if r[2].date() == day]
            opening = value
            for r in mine:
                value = r[3] if r[3] is not None else value
            want.append((key, day, opening, value, len(mine)))
            day += dt.timedelta(days=1)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(n == 0 for *_, n in want)


def test_opening_values_by_hour_and_month(spark):
    rows = [(1, 1, T0, 5), (2, 1, T0 + dt.timedelta(hours=3), None), (3, 1, T0 + dt.timedelta(hours=4), 7)]
    got = opening_values(frame(spark, rows), "k", "ts", ["v"], period="hour").orderBy("hour").collect()
    assert [(r.hour.hour, r.opening_v, r.closing_v, r.n_readings) for r in got] == [
        (0, None, 5, 1), (1, 5, 5, 0), (2, 5, 5, 0), (3, 5, 5, 1), (4, 5, 7, 1)
    ]
    rows = [(1, 1, T0, 5), (2, 1, T0.replace(month=12), 9)]
    assert opening_values(frame(spark, rows), "k", "ts", ["v"], period="month").count() == 12
    assert opening_values(frame(spark, []), "k", "ts", ["v"]).count() == 0


@pytest.mark.parametrize("options", METHODS)
def test_distance_counts_from_zero_after_a_reset(spark, options):
    rows = make_rows(9)
    got = distance_travelled(frame(spark, rows), "k", "ts", "v", tiebreak="id", **options)
    want = {}
    for key, rs in groups(rows).items():
        way = resets = 0
        before = None
        for r in rs:
            if r[3] is None:
                continue
            if before is not None:
                way += r[3] - before if r[3] >= before else r[3]
                resets += r[3] < before
            before = r[3]
        want[key] = (way, resets)
    assert {r.k: (r.distance, r.n_resets) for r in got.collect()} == want


def expected_asof(left, right, tolerance, keyed):
    out = []
    for i, k, t, _ in left:
        best = None
        for _, rk, rt, rv in right:
            if t is None or rt is None or (keyed and (k is None or rk != k)):
                continue
            if rt <= t and (t - rt).total_seconds() <= tolerance:
                mine = (rt, rv is not None, rv or 0)
                best = mine if best is None or mine > best else best
        out.append((i, None if best is None or not best[1] else best[2], None if best is None else best[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("partitions", [None, 500])
def test_asof_join(spark, kind, keyed, partitions):
    rnd = random.Random(4)
    left = make_rows(1, 500, 10)
    left += [(1000 + i, 1, T0 + dt.timedelta(hours=30, minutes=i % 7), 0) for i in range(300)]  # a hot bucket
    right = [(i, rnd.randint(1, 9), T0 + dt.timedelta(minutes=rnd.randint(-900, 9000)), rnd.randint(0, 9)) for i in range(150)]
    right += [(200, 1, None, 5), (201, None, T0, 6), (202, 1, T0 + dt.timedelta(hours=30), None)]
    schema = f"id long, k long, ts {kind}, v long"
    ldf = spark.createDataFrame(left, schema).repartition(3)
    rdf = spark.createDataFrame(right, schema).selectExpr("k", "ts as at", "v as w").repartition(2)
    got = asof_join(
        ldf, rdf, "ts", "at", ["w"], tolerance=7200, by=["k"] if keyed else [], as_of="seen", partitions=partitions
    )
    assert got.columns == ["id", "k", "ts", "v", "w", "seen"]
    rows = [(r.id, r.w, r.seen) for r in got.collect()]
    assert sorted(rows, key=str) == expected_asof(left, right, 7200, keyed)


def test_asof_join_of_empty_sides(spark):
    some, none = frame(spark, make_rows(2, 30)), frame(spark, [])
    right = some.selectExpr("ts as at", "v as w")
    assert asof_join(none, right, "ts", "at", ["w"], tolerance=60).count() == 0
    got = asof_join(some, right.limit(0), "ts", "at", ["w"], tolerance=60)
    assert got.count() == 30 and got.filter("w is not null or as_of is not null").isEmpty()


@pytest.mark.parametrize("options", METHODS)
def test_missing_hours(spark, options):
    rows = make_rows(8, 400, 12)
    got = missing_periods(frame(spark, rows), "k", "ts", **options)
    want = set()
    for key, rs in groups(rows).items():
        hours = {r[2] for r in rs if r[2] is not None}
        at = min(hours)
        while at < max(hours):
            if at not in hours:
                want.add((key, at))
            at += dt.timedelta(hours=1)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


@pytest.mark.parametrize("partitions", ["1", "8", "37"])
def test_positions_are_the_sorted_order(spark, partitions):
    rnd = random.Random(6)
    rows = [(i, rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice("abc")) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v long, s string").repartition(5)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = with_position(df, [F.col("v").desc_nulls_last(), "s", "id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    assert {r.id: r.position for r in got} == {r[0]: i for i, r in enumerate(want, 1)}
    assert with_position(df.limit(0), ["id"]).count() == 0
    tied = with_position(df, ["s"]).collect()  # ties take consecutive places
    assert sorted(r.position for r in tied) == list(range(1, 501))
    assert [r.s for r in sorted(tied, key=lambda r: r.position)] == sorted(r[2] for r in rows)
