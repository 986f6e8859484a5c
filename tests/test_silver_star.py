import datetime as dt

import pytest
from conftest import alerts_df, at, one, routes_df, rows, trips_df, update, updates_df
from pyspark.sql import functions as F

from headway import schemas
from headway.operators.latest import latest_per_key
from headway.plans import silver, staging, star


def reconciled(spark, updates, trips=None, stop_times=None):
    trips = trips_df(spark, "t1") if trips is None else trips
    if stop_times is None:
        stop_times = spark.createDataFrame([], schemas.static_schema("stop_times"))
    return silver.trip_stop_performance(staging.trip_updates(updates), trips, stop_times)


def stop_times_df(spark, *items):
    """(trip, stop, sequence, arrival, version, day of load)"""
    return spark.createDataFrame(
        [(t, s, q, a, a, v, "f", at(f"2026-09-{d:02}T00:00:00")) for t, s, q, a, v, d in items],
        schemas.static_schema("stop_times"),
    )


def test_newest_report_wins(spark):
    updates = updates_df(
        spark,
        {"arrival_delay_seconds": 1.0, "_ingested_at": at("2026-09-16T08:00:00")},
        {"arrival_delay_seconds": 3.0, "_ingested_at": at("2026-09-16T09:00:00")},
        {"arrival_delay_seconds": 2.0, "_ingested_at": at("2026-09-16T08:30:00")},
    )
    assert one(reconciled(spark, updates)).arrival_delay_seconds == 3.0


def test_a_trip_id_used_on_two_days_keeps_both(spark):
    updates = updates_df(
        spark, {}, {"feed_timestamp": at("2026-09-17T08:00:00")}, {"start_date": "20260918"}
    )
    got = reconciled(spark, updates).select("service_date")
    assert rows(got) == [("20260916",), ("20260917",), ("20260918",)]


def test_stops_that_all_report_sequence_zero_are_kept(spark):
    updates = updates_df(spark, *[{"stop_id": f"s{i}", "stop_sequence": 0} for i in range(34)])
    assert reconciled(spark, updates).count() == 34


def test_result_does_not_depend_on_file_order(spark):
    items = [{"entity_id": f"e{i}", "arrival_delay_seconds": float(i)} for i in range(20)]
    forward = rows(reconciled(spark, updates_df(spark, *items)))
    assert rows(reconciled(spark, updates_df(spark, *reversed(items)))) == forward


def test_unmatched_trips_are_kept_and_flagged(spark):
    got = reconciled(spark, updates_df(spark, {}, {"trip_id": "ghost"}))
    assert rows(got.select("trip_id", "is_orphan_trip", "trip_headsign")) == [
        ("ghost", True, None),
        ("t1", False, "to t1"),
    ]


def test_schedule_is_joined_by_sequence_and_the_stop_compared(spark):
    updates = updates_df(spark, {}, {"stop_id": "s2", "stop_sequence": 2}, {"stop_id": "s9", "stop_sequence": 9})
    schedule = stop_times_df(
        spark, ("t1", "s1", 1, "08:00:00", "v1", 1), ("t1", "other", 2, "25:10:00", "v1", 1)
    )
    got = reconciled(spark, updates, stop_times=schedule)
    assert rows(got.select("stop_id", "scheduled_arrival_time_of_day", "schedule_stop_matches")) == [
        ("s1", "08:00:00", True),
        ("s2", "25:10:00", False),
        ("s9", None, None),
    ]


def test_newest_timetable_version_wins_per_key(spark):
    bronze = stop_times_df(
        spark,
        ("t1", "s1", 1, "old", "v1", 1),
        ("t1", "s1", 1, "new", "v2", 9),
        ("t2", "s1", 1, "only", "v1", 1),
        ("t3", "s1", 1, "a", "v1", 5),
        ("t3", "s1", 1, "b", "v2", 5),
    )
    got = staging.static_table("stop_times", bronze).select("trip_id", "arrival_time")
    assert rows(got) == [("t1", "new"), ("t2", "only"), ("t3", "b")]


def test_version_in_force_on_the_service_date(spark):
    snapshot = silver.latest_snapshot(
        updates_df(spark, *[{"start_date": d} for d in ("20260901", "20260910", "20260915", "20261001")])
    )
    versions = spark.createDataFrame(
        [("v1", "20260905"), ("v2", "20260915")], "_feed_version string, valid_from string"
    )
    trips = trips_df(spark, "t1", version="v2")
    got = silver.match_trips_by_version(snapshot, trips, versions)
    assert rows(got.select("service_date", "_feed_version", "is_orphan_trip")) == [
        ("20260901", "v1", True),
        ("20260910", "v1", True),
        ("20260915", "v2", False),
        ("20261001", "v2", False),
    ]


def test_summary(spark):
    updates = updates_df(
        spark,
        {},
        {"stop_id": "s2", "arrival_delay_seconds": -700.0},
        {"stop_id": "s3", "arrival_delay_seconds": None},
        {"trip_id": "ghost", "arrival_delay_seconds": 20.0},
    )
    got = one(silver.silver_summary(reconciled(spark, updates)))
    assert tuple(got) == (4, 1, 1, -223.3, -700.0, 20.0)


def test_latest_per_key_limits_each_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(df, ["k"], [F.col("id").desc()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in text and text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert rows(plan) == [(0, 99), (1, 97), (2, 98)]


def test_calendar_spans_first_start_to_last_end(spark):
    calendar = spark.createDataFrame(
        [("20260918", "20260920"), ("20260916", "20260917")], "start_date string, end_date string"
    )
    assert rows(star.dim_date(calendar)) == [
        (20260916, dt.date(2026, 9, 16), "Wednesday", True),
        (20260917, dt.date(2026, 9, 17), "Thursday", True),
        (20260918, dt.date(2026, 9, 18), "Friday", True),
        (20260919, dt.date(2026, 9, 19), "Saturday", False),
        (20260920, dt.date(2026, 9, 20), "Sunday", False),
    ]
    assert star.dim_date(calendar.limit(0)).isEmpty()


def test_dim_route(spark):
    got = one(star.dim_route(routes_df(spark, ("APS_1a", "T8", 2))))
    assert tuple(got) == (-3402953319642480407, "APS_1a", "T8", "APS_1a long", "train", "op")


def test_fact_flags(spark):
    silver_rows = reconciled(
        spark,
        updates_df(
            spark,
            {"arrival_delay_seconds": 301.0},
            {"stop_id": "s2", "arrival_delay_seconds": None, "schedule_relationship": "CANCELED"},
            {"stop_id": "s3", "start_date": "not a date"},
        ),
    )
    fact = star.fact_trip_stop(silver_rows)
    assert fact.columns == schemas.FACT_TRIP_STOP.names
    assert rows(fact.select("stop_id", "date_key", "is_late", "is_cancelled", "is_delay_outlier")) == [
        ("s1", 20260916, True, False, False),
        ("s2", 20260916, None, True, None),
        ("s3", None, False, False, False),
    ]
    later = star.fact_trip_stop(silver_rows, on_time_threshold=400)
    assert later.filter("is_late").isEmpty()


def test_repeated_alert_captures_are_one_row_and_stop_alerts_are_left_out(spark):
    alerts = alerts_df(
        spark,
        {},
        {"_ingested_at": at("2026-09-16T08:15:05")},
        {"route_id": "r2"},
        {"route_id": None, "stop_id": "s1"},
        {"route_id": ""},
    )
    got = star.fact_service_alerts(staging.service_alerts(alerts))
    assert rows(got.select("alert_id", "route_id")) == [("a1", "r1"), ("a1", "r2")]


def test_version_ties_and_days_without_a_version(spark):
    dates = spark.createDataFrame([("20260901",), ("20260905",), ("20260906",), ("20261231",), (None,)], "service_date string")
    versions = [("v2", "20260905"), ("v1", "20260905"), ("v9", None), ("v3", "20261001"), ("v3", "20261001")]
    got = silver.versions_by_date(dates, spark.createDataFrame(versions, "_feed_version string, valid_from string"))
    want = [("20260901", "v1"), ("20260905", "v2"), ("20260906", "v2"), ("20261231", "v3"), (None, "v1")]
    assert rows(got) == sorted(want, key=repr)
    none = silver.versions_by_date(dates, spark.createDataFrame([], "_feed_version string, valid_from string"))
    assert {r[1] for r in none.collect()} == {None}


@pytest.mark.parametrize("count", [2, 2000])
def test_version_lookup_costs_the_same_for_any_number_of_versions(spark, count):
    """No array of versions beside each row, no comparison of rows with versions: an equi join with a table of days."""
    snapshot = silver.latest_snapshot(updates_df(spark, *[{"start_date": d} for d in ("20260901", "20260910")]))
    versions = spark.range(count).selectExpr("concat('v', lpad(id, 5, '0')) AS _feed_version", "cast(20000000 + id AS string) AS valid_from")
    found = silver.with_version_on_date(snapshot, versions, silver.service_dates(updates_df(spark, {"start_date": "20260901"}, {"start_date": "20260910"})))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert rows(found.select("_feed_version")) == [(f"v{count - 1:05}",)] * 2
