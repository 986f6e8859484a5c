"""Window operators against brute force."""

import datetime as dt
import random

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from headway.operators.intervals import _clipped_pieces, flag_covered, interval_totals, merged_windows

START = at("2026-09-16T00:00:00")


def minute(n):
    return START + dt.timedelta(minutes=n)


def points_df(spark, points):
    return spark.createDataFrame(
        [(k, minute(m), v) for k, m, v in points], "k string, at timestamp, v bigint"
    )


def windows_df(spark, windows):
    return spark.createDataFrame(
        [(k, g, None if a is None else minute(a), None if b is None else minute(b)) for k, g, a, b in windows],
        "k string, g string, a timestamp, b timestamp",
    )


def inside(m, a, b, bounds):
    if a is None or b is None:
        return False
    return (a <= m if bounds[0] else a < m) and (m <= b if bounds[1] else m < b)


def brute_totals(points, windows, bounds):
    totals = {}
    for k, g, a, b in windows:
        for pk, m, v in points:
            if pk == k and k is not None and inside(m, a, b, bounds):
                n, s = totals.get((k, g), (0, 0))
                totals[(k, g)] = (n + 1, s + (v or 0))
    return sorted(((k, g, n, s) for (k, g), (n, s) in totals.items()), key=repr)


def random_case(seed):
    rng = random.Random(seed)
    # One key holds most rows, instants repeat, and windows touch bucket borders.
    keys = ["hot"] * 6 + ["a", "b", None]
    points = [
        (rng.choice(keys), rng.choice([0, 59, 60, 61, rng.randrange(0, 600)]), rng.choice([None, 1, -7, 300]))
        for _ in range(300)
    ]
    windows = []
    for i in range(40):
        a = rng.choice([0, 60, 120, rng.randrange(-100, 600)])
        b = rng.choice([None, a, a + 60, a - 5, a + rng.randrange(0, 400)])
        windows.append((rng.choice(keys), f"g{i % 5}", a, b))
    return points, windows


@pytest.mark.parametrize("bounds", [(True, True), (True, False), (False, True), (False, False)])
def test_interval_totals_match_brute_force(spark, bounds):
    points, windows = random_case(sum(bounds) + 7)
    got = interval_totals(
        points_df(spark, points),
        windows_df(spark, windows),
        key="k",
        at="at",
        start="a",
        end="b",
        group=["k", "g"],
        measures={"s": F.col("v")},
        bounds=bounds,
    )
    assert rows(got.select("k", "g", "point_count", "s")) == brute_totals(points, windows, bounds)


def test_interval_totals_of_overlapping_windows_count_twice(spark):
    got = interval_totals(
        points_df(spark, [("k", 5, 10)]),
        windows_df(spark, [("k", "g", 0, 10), ("k", "g", 5, 20)]),
        key="k", at="at", start="a", end="b", group=["g"], measures={"s": F.col("v")},
    )
    assert rows(got) == [("g", 2, 20)]


def test_key_totals_count_every_point_even_without_a_time(spark):
    points = points_df(spark, [("k", 5, 10), ("k", 500, 1), ("o", 5, 7)])
    untimed = spark.createDataFrame([("k", None, 100)], points.schema)
    got = interval_totals(
        points.union(untimed),
        windows_df(spark, [("k", "g", 0, 10)]),
        key="k", at="at", start="a", end="b", group=["k", "g"], measures={"s": F.col("v")},
    )
    assert rows(got) == [("k", "g", 1, 10, 111)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_flag_covered_matches_brute_force(spark, seed):
    points, windows = random_case(seed)
    got = flag_covered(
        points_df(spark, points), windows_df(spark, windows),
        key="k", at="at", start="a", end="b", name="open",
    )
    expected = sorted(
        (
            (k, v, any(wk == k and k is not None and inside(m, a, b, (True, True)) for wk, _, a, b in windows), m)
            for k, m, v in points
        ),
        key=repr,
    )
    minutes = ((F.unix_seconds("at") - int(START.timestamp())) / 60).cast("int")
    assert rows(got.select("k", "v", "open", minutes)) == expected


def test_flag_covered_survives_far_off_ends(spark):
    windows = windows_df(spark, [("k", "g", 30, 0)]).select(
        "k", "a", F.timestamp_seconds(F.lit(253402300799)).alias("b")
    )
    got = flag_covered(
        points_df(spark, [("k", 29, 1), ("k", 30, 2), ("k", 500, 3)]), windows,
        key="k", at="at", start="a", end="b", name="open",
    )
    assert rows(got.select("v", "open")) == [(1, False), (2, True), (3, True)]


def test_overlapping_windows_are_united(spark):
    rows_in = [("k", "g", 0, 10), ("k", "h", 5, 20), ("k", "i", 20, 25), ("k", "j", 30, 40), ("k", "l", 31, 33), ("m", "g", 1, 2), (None, "g", 1, 2)]
    windows = windows_df(spark, rows_in)
    got = merged_windows(windows, "k", "a", "b")
    assert [(r[0], r[2] - r[1]) for r in rows(got)] == [(r[0], b - a) for r, (a, b) in zip(rows(got), [(r[1], r[2]) for r in rows(got)], strict=True)]
    assert sorted(r[0] for r in rows(got)) == ["k", "k", "m"]


def test_a_bucket_lists_one_piece_however_many_windows_overlap(spark):
    hour, year = 3600, 365 * 24 * 3600
    base = spark.range(300).select(
        F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("a"), F.timestamp_seconds(F.col("id") * 7 + year).alias("b")
    )
    horizon = spark.range(1).select(F.timestamp_seconds(F.lit(0)).alias("lo"), F.timestamp_seconds(F.lit(year)).alias("hi"))
    pieces = _clipped_pieces(merged_windows(base, "k", "a", "b"), horizon, hour)
    assert pieces.count() <= year // hour + 1
    assert pieces.groupBy("_key", "_bucket").count().agg(F.max("count")).first()[0] == 1


def test_no_windows_and_no_points(spark):
    empty_points, empty_windows = points_df(spark, [("k", 1, 1)]).limit(0), windows_df(spark, [("k", "g", 0, 9)]).limit(0)
    some_points, some_windows = points_df(spark, [("k", 1, 1)]), windows_df(spark, [("k", "g", 0, 9)])
    names = dict(key="k", at="at", start="a", end="b")
    for p, w in ((empty_points, some_windows), (some_points, empty_windows)):
        assert interval_totals(p, w, group=["g"], measures={"s": F.col("v")}, **names).isEmpty()
    assert rows(flag_covered(some_points, empty_windows, name="open", **names).select("open")) == [(False,)]


@pytest.mark.parametrize("seed", range(3))
def test_windows_are_united_as_by_one_scan(spark, seed):
    """Windows within a day, over days, touching and nested, of one hot key and others."""
    rng = random.Random(seed)
    windows = []
    for i in range(400):
        begin = rng.randrange(0, 6 * 86400, rng.choice([1, 3600]))
        windows.append(("hot" if i % 3 else f"k{i % 7}", begin, begin + rng.choice([0, 60, 3600, 90000, -5])))
    df = spark.createDataFrame(windows, "k string, a bigint, b bigint").selectExpr("k", "timestamp_seconds(a) AS a", "timestamp_seconds(b) AS b")
    got = merged_windows(df, "k", "a", "b").selectExpr("_key", "unix_seconds(_lo)", "unix_seconds(_hi)")
    want = []
    for key in {k for k, _, _ in windows}:
        open_now = None
        for a, b in sorted((a, b) for k, a, b in windows if k == key and a <= b):
            if open_now and a <= open_now[1]:
                open_now[1] = max(open_now[1], b)
            else:
                open_now = [a, b]
                want.append((key, open_now))
    assert rows(got) == sorted(((k, *w) for k, w in want), key=repr)


def test_a_hot_keys_windows_meet_day_by_day(spark):
    """Of a key with all windows, a day's are in one task, and one row per island and day is left for the key."""
    df = spark.range(86400 * 3).selectExpr("concat('hot', id % 1) AS k", "timestamp_seconds(id) AS a", "timestamp_seconds(id + 1) AS b")
    plan = merged_windows(df, "k", "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan and "_day" in plan
    assert rows(merged_windows(df, "k", "a", "b").selectExpr("unix_seconds(_lo)", "unix_seconds(_hi)")) == [(0, 86400 * 3)]
