import datetime as dt

import pytest
from conftest import at, one
from pyspark.sql import functions as F

from headway import constants as C
from headway.functions import columns as fx
from headway.functions import shares


def value(spark, expression, **inputs):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()])
    return one(df.select(expression))[0]


@pytest.mark.parametrize(
    "start, expected", [("", "20260916"), (None, "20260916"), ("20260917", "20260917")]
)
def test_blank_start_date_falls_back_to_the_feed_day(spark, start, expected):
    df = spark.createDataFrame([(start, at("2026-09-16T23:59:59"))], "s string, t timestamp")
    assert one(df.select(fx.service_date(F.col("s"), F.col("t"))))[0] == expected


@pytest.mark.parametrize("delay, late", [(300.0, False), (301.0, True), (-5.0, False)])
def test_late_is_strictly_over_the_threshold(spark, delay, late):
    assert value(spark, fx.is_late(F.col("d")), d=delay) is late


def test_unknown_delay_is_neither_late_nor_on_time(spark):
    df = spark.createDataFrame([(None,)], "d double")
    assert one(df.select(fx.is_late(F.col("d")), fx.is_delay_outlier(F.col("d")))) == (None, None)


@pytest.mark.parametrize(
    "delay, outlier", [(-600.0, False), (-601.0, True), (7200.0, False), (7201.0, True)]
)
def test_outlier_bounds_are_plausible_themselves(spark, delay, outlier):
    assert value(spark, fx.is_delay_outlier(F.col("d")), d=delay) is outlier


@pytest.mark.parametrize(
    "code, mode", [(0, "light_rail"), (2, "train"), (3, "bus"), (4, "ferry"), (1, "other")]
)
def test_mode(spark, code, mode):
    assert value(spark, fx.mode(F.col("c")), c=code) == mode


def test_surrogate_keys_match_published_ones(spark):
    keys = {
        "APS_1a": -3402953319642480407,
        "APS_1b": 3528247148565883103,
        "APS_1c": -6417094206083242795,
    }
    for route, key in keys.items():
        assert value(spark, fx.surrogate_key(F.col("r")), r=route) == key


def test_bad_service_date_has_no_date_key(spark):
    assert value(spark, fx.date_key(F.col("d")), d="soon") is None
    assert value(spark, fx.date_key(F.col("d")), d="20260916") == 20260916


def test_zero_epoch_is_missing(spark):
    df = spark.createDataFrame([(0,), (None,), (1726000000,)], "s bigint")
    got = [r[0] for r in df.select(fx.epoch_timestamp(F.col("s")).cast("bigint")).collect()]
    assert got == [None, None, 1726000000]


@pytest.mark.parametrize("code, name", [(9, "MAINTENANCE"), (None, "UNKNOWN_CAUSE"), (77, "UNKNOWN_CAUSE")])
def test_enum_names(spark, code, name):
    df = spark.createDataFrame([(code,)], "c int")
    assert one(df.select(fx.enum_name(F.col("c"), C.ALERT_CAUSE)))[0] == name


def test_unset_effect_is_unknown(spark):
    df = spark.createDataFrame([(None,)], "c int")
    assert one(df.select(fx.enum_name(F.col("c"), C.ALERT_EFFECT)))[0] == "UNKNOWN_EFFECT"


def test_ratios_of_nothing_are_null(spark):
    assert value(spark, fx.pct(F.lit(0), F.lit(0)), x=1) is None
    assert value(spark, fx.ratio(F.lit(1), F.lit(0)), x=1) is None


def test_unknown_delay_lowers_punctuality(spark):
    df = spark.createDataFrame(
        [(10.0, False, False), (400.0, True, False), (None, None, True)],
        "arrival_delay_seconds double, is_late boolean, is_cancelled boolean",
    )
    partial = df.agg(*shares.punctuality_partials())
    got = one(partial.select("*", shares.pct_on_time().alias("p"), shares.mean_delay().alias("m")))
    assert (got.trip_stop_count, got.scored_count, got.late_count, got.cancelled_count) == (3, 2, 1, 1)
    assert got.p == pytest.approx(100 / 3)
    assert got.m == 205.0


def test_day_of_week_numbers_start_on_sunday(spark):
    df = spark.createDataFrame([(dt.date(2026, 9, 20),)], "d date")
    assert one(df.select(F.dayofweek("d")))[0] == 1
