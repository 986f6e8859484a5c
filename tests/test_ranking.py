import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.operators.ranking import cumulative_share, magnitude_bucket, top_n

# Published totals of 17 lines with their shares and running shares, worst first.
LINES = [
    ("T8", 413527, 16.4, 16.4),
    ("T2", 351813, 13.9, 30.3),
    ("T4", 320758, 12.7, 43.1),
    ("T1", 267545, 10.6, 53.7),
    ("SCO", 259536, 10.3, 64.0),
    ("CCN", 217515, 8.6, 72.6),
    ("T5", 177683, 7.0, 79.6),
    ("T3", 99640, 4.0, 83.6),
    ("BMT", 97260, 3.9, 87.4),
    ("SHL", 78884, 3.1, 90.6),
    ("T9", 71671, 2.8, 93.4),
    ("STH", 68018, 2.7, 96.1),
    ("T6", 56950, 2.3, 98.4),
    ("NRC", 30429, 1.2, 99.6),
    ("NRW", 7816, 0.3, 99.9),
    ("T7", 2438, 0.1, 100.0),
    ("WST", 699, 0.0, 100.0),
]


def test_published_shares(spark):
    df = spark.createDataFrame([(n, v) for n, v, _, _ in LINES], "line string, v bigint")
    got = cumulative_share(df, "v", ["line"], "share", "running").select(
        "line", "v", F.round("share", 1), F.round("running", 1)
    )
    assert rows(got) == sorted(LINES, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_running_share_matches_a_sorted_scan(spark, seed):
    rng = random.Random(seed)
    values = [(f"n{i:04}", rng.choice([0, 0, 5, 5, rng.randrange(0, 10**rng.randrange(1, 12))])) for i in range(400)]
    got = cumulative_share(
        spark.createDataFrame(values, "n string, v bigint"), "v", ["n"], "share", "running"
    ).collect()
    total, running, expected = sum(v for _, v in values), 0, {}
    for n, v in sorted(values, key=lambda x: (-x[1], x[0])):
        running += v
        expected[n] = 100.0 * running / total
    assert {r.n: r.running for r in got} == pytest.approx(expected)


def test_all_zero_has_no_share(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "n string, v bigint")
    assert rows(cumulative_share(df, "v", ["n"], "s", "r").select("s", "r")) == [(None, None)] * 2


def test_buckets_never_contradict_the_order(spark):
    values = sorted({0, 1, 2, 3, 2**62, 10**18, *range(0, 5000, 7), *(2**i - 1 for i in range(60)), *(2**i for i in range(60))})
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] for r in df.orderBy("v").select(magnitude_bucket(F.col("v"))).collect()]
    assert got == sorted(got, reverse=True)
    assert len(set(got)) < 800


def test_top_n(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(9)], "a int, b int")
    got = [tuple(r) for r in top_n(df, [F.col("a").asc(), F.col("b").desc()], 4).collect()]
    assert got == [(0, 6), (0, 3), (0, 0), (1, 7)]


def test_zeros_are_spread_over_tasks(spark):
    """A million of equal rows, which add nothing, are in no single task, and their running share is still the whole."""
    zeros = spark.range(1_000_000).select(F.col("id").cast("string").alias("n"), F.lit(0).cast("bigint").alias("v"))
    df = zeros.union(spark.createDataFrame([("a", 30), ("b", 10)], "n string, v bigint"))
    buckets = df.groupBy(magnitude_bucket(F.col("v"), F.xxhash64("n")).alias("m")).count().collect()
    assert max(r["count"] for r in buckets) < 20_000 and len(buckets) == 66
    got = cumulative_share(df, "v", ["n"], "s", "r").groupBy("s", "r").count()
    assert rows(got) == [(0.0, 100.0, 1_000_000), (25.0, 100.0, 1), (75.0, 75.0, 1)]
