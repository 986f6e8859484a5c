"""Plans that must hold at scale."""

import re

import pytest
from conftest import alerts_df, at, routes_df, trips_df, updates_df
from pyspark.sql import functions as F

from headway.operators.intervals import flag_covered
from headway.plans import marts, silver, staging, star
from headway.sinks import tables


SMALL_AND_SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.shuffle.partitions": "8",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def settings(spark, **conf):
    class Changed:
        def __enter__(self):
            self.old = {k: spark.conf.get(k, None) for k in conf}
            for k, v in conf.items():
                spark.conf.set(k, v)

        def __exit__(self, *_):
            for k, v in self.old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return Changed()


@pytest.fixture(scope="module")
def stored_fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "fact")
    updates = updates_df(
        spark, *[{"stop_id": f"s{i}", "feed_timestamp": at(f"2026-09-16T{i % 24:02}:00:00")} for i in range(50)]
    )
    fact = star.fact_trip_stop(silver.match_trips(silver.latest_snapshot(updates), trips_df(spark, "t1")))
    tables.write_table(fact, path, ["service_date"])
    return spark.read.parquet(path)


def test_marts_read_only_their_columns_and_push_the_filter(spark, stored_fact):
    routes = star.dim_route(routes_df(spark, ("r1", "T1", 2)))
    text = plan(marts.line_delay_concentration(stored_fact, routes))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"route_key", "arrival_delay_seconds", "is_orphan_trip"}
    assert "Not(EqualTo(is_orphan_trip,true))" in text


def test_facts_are_aggregated_before_the_dimension_join(spark, stored_fact):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        routes = star.dim_route(routes_df(spark, ("r1", "T1", 2)))
        text = plan(marts.route_daily_performance(stored_fact, routes))
    join = text.index("SortMergeJoin")
    assert text.index("FileScan") > join and "HashAggregate" in text[join : text.index("FileScan")]


def test_no_plan_brings_all_rows_to_one_task(spark, stored_fact):
    """Single-partition exchanges carry one row per bucket or partial aggregates, never fact rows."""
    routes = star.dim_route(routes_df(spark, ("r1", "T1", 2)))
    for df in (marts.line_delay_concentration(stored_fact, routes),):
        for part in plan(df).split("Exchange SinglePartition")[1:]:
            assert "HashAggregate" in part[: part.index("FileScan")]


def test_alert_impact_forms_no_pairs(spark, stored_fact):
    window = {
        "active_period_start": at("2026-09-16T08:00:00"),
        "active_period_end": at("2026-09-16T10:00:00"),
    }
    routes = star.dim_route(routes_df(spark, ("r1", "T1", 2)))
    alerts = star.fact_service_alerts(staging.service_alerts(alerts_df(spark, window)))
    text = plan(marts.alert_delay_impact(stored_fact, routes, alerts))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_a_hot_trip_is_split_in_both_reconciliation_joins(spark):
    """A trip with most of the live rows meets versioned timetables without one task taking it all."""
    live = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("trip_id"),
        (F.col("id") % 2).alias("stop_sequence"),
        F.concat(F.lit("stop"), F.col("id")).alias("stop_id"),
        F.lit(1.0).alias("arrival_delay_seconds"),
    )
    lineage = [
        F.lit("v1").alias("_feed_version"),
        F.lit("f").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    ]
    known = spark.range(2000).select(
        F.when(F.col("id") == 1, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("trip_id"),
        F.lit("r1").alias("route_id"),
        F.lit("wk").alias("service_id"),
        F.lit("x").alias("trip_headsign"),
        F.lit("s").alias("stop_id"),
        (F.col("id") % 2).alias("stop_sequence"),
        F.lit("08:00:00").alias("arrival_time"),
        F.lit("08:00:00").alias("departure_time"),
        *lineage,
    )
    with settings(spark, **SMALL_AND_SKEWED):
        matched = silver.match_trips(live, staging.static_table("trips", known))
        scheduled = silver.attach_schedule(matched, staging.static_table("stop_times", known))
        got = scheduled.collect()
        assert len(got) == 200_000
        assert sum(not r.is_orphan_trip for r in got) >= 180_000
        assert sum(r.scheduled_arrival_time_of_day is not None for r in got) >= 80_000
        assert plan(scheduled).count("skew=true") >= 2


def test_a_hot_route_is_split_in_the_alert_lookup(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).alias("route"),
        F.timestamp_seconds(F.lit(1726000000) + F.col("id") % 7).alias("at"),
        F.concat(F.lit("row"), F.col("id")).alias("payload"),
    )
    windows = spark.range(2000).select(
        F.col("id").alias("route"),
        F.timestamp_seconds(F.lit(1726000003)).alias("a"),
        F.timestamp_seconds(F.lit(1726000005)).alias("b"),
    )
    with settings(spark, **SMALL_AND_SKEWED):
        flagged = flag_covered(
            rows, windows, key="route", at="at", start="a", end="b", name="open"
        )
        got = flagged.collect()
        assert len(got) == 200_000
        assert all(r.open == (3 <= r.at.second - 40 <= 5 and r.route < 2000) for r in got)
        assert "skew=true" in plan(flagged)
