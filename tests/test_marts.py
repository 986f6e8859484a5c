import datetime as dt

import pytest
from conftest import alerts_df, at, one, routes_df, rows, trips_df, updates_df

from headway.plans import findings, marts, silver, staging, star

ROUTES = [("r1", "T1", 2), ("r2", "T1", 2), ("r3", "T2", 3), ("rx", None, 2)]


@pytest.fixture(scope="module")
def routes(spark):
    return star.dim_route(routes_df(spark, *ROUTES))


def fact(spark, *items):
    """(route, stop, delay, extra values)"""
    updates = updates_df(
        spark,
        *[
            {"route_id": r, "stop_id": s, "arrival_delay_seconds": d, **(x[0] if x else {})}
            for r, s, d, *x in items
        ],
    )
    return star.fact_trip_stop(
        silver.match_trips(silver.latest_snapshot(updates), trips_df(spark, "t1"))
    )


def test_route_daily_performance(spark, routes):
    got = marts.route_daily_performance(
        fact(
            spark,
            ("r1", "a", 10.0),
            ("r1", "b", 301.0),
            ("r1", "c", None, {"schedule_relationship": "CANCELED"}),
            ("r3", "d", -20.0),
            ("rx", "e", 9.0),
            ("r9", "f", 9.0),
            ("r1", "g", 9999.0, {"trip_id": "ghost"}),
        ),
        routes,
    )
    assert rows(got) == [
        (20260916, "r1", "T1", "train", 3, 1, 1, 33.3, 155.5),
        (20260916, "r3", "T2", "bus", 1, 0, 0, 100.0, -20.0),
    ]


def test_unknown_delays_only(spark, routes):
    got = one(marts.route_daily_performance(fact(spark, ("r1", "a", None)), routes))
    assert (got.late_count, got.pct_on_time, got.avg_arrival_delay_seconds) == (0, 0.0, None)


def test_line_totals_ignore_early_arrivals_and_join_routes_of_a_line(spark, routes):
    got = marts.line_delay_concentration(
        fact(
            spark,
            ("r1", "a", 100.0),
            ("r2", "b", 200.0),
            ("r1", "c", -500.0),
            ("r1", "d", None),
            ("r3", "e", 100.0),
            ("rx", "f", 900.0),
        ),
        routes,
    )
    assert rows(got) == [
        ("T1", "train", 300.0, 5.0, 4, 75.0, 75.0),
        ("T2", "bus", 100.0, 1.7, 1, 25.0, 100.0),
    ]


def alert_case(spark):
    def seen(clock):
        return {"feed_timestamp": at(f"2026-09-16T{clock}")}

    facts = fact(
        spark,
        ("r1", "a", 60.0, seen("07:59:59")),
        ("r1", "b", 100.0, seen("08:00:00")),
        ("r1", "c", 200.0, seen("10:00:00")),
        ("r1", "d", 400.0, seen("10:00:01")),
        ("r1", "e", None, seen("09:00:00")),
        ("rx", "f", 50.0, seen("09:00:00")),
        ("r1", "g", 7.0, {**seen("09:00:00"), "trip_id": "ghost"}),
    )
    window = {
        "active_period_start": at("2026-09-16T08:00:00"),
        "active_period_end": at("2026-09-16T10:00:00"),
    }
    alerts = alerts_df(
        spark,
        window,
        {**window, "_ingested_at": at("2026-09-16T08:20:00")},
        {**window, "entity_id": "a2", "route_id": "rx", "header_text": "Depot, works"},
        {**window, "entity_id": "a3", "header_text": "No end", "active_period_end": None},
        {
            "entity_id": "a4",
            "header_text": "Backwards",
            "active_period_start": window["active_period_end"],
            "active_period_end": window["active_period_start"],
        },
        {**window, "entity_id": "a5", "route_id": "r3", "header_text": "Nobody there"},
    )
    return facts, star.fact_service_alerts(staging.service_alerts(alerts))


def test_alert_impact_includes_both_ends_and_non_revenue_routes(spark, routes):
    facts, alerts = alert_case(spark)
    assert rows(marts.alert_delay_impact(facts, routes, alerts)) == [
        ("r1", "Works", "MAINTENANCE", "DETOUR", 3, 150.0, 190.0, -40.0),
        ("rx", "Depot, works", "MAINTENANCE", "DETOUR", 1, 50.0, 50.0, 0.0),
    ]


def test_delay_before_during_after(spark):
    facts, alerts = alert_case(spark)
    got = marts.delay_around_alerts(facts, alerts, margin="1 hour")
    keep = got.filter("header_text = 'Works'").select("phase", "observations", "avg_delay_seconds")
    assert rows(keep) == [("after", 1, 400.0), ("before", 1, 60.0), ("during", 3, 150.0)]


def test_findings_use_the_scored_population(spark, routes):
    facts = fact(
        spark,
        ("r1", "a", 10.0),
        ("r2", "b", 400.0),
        ("r1", "c", 9000.0),
        ("r1", "d", None),
        ("r1", "e", 10.0, {"schedule_relationship": "CANCELED"}),
        ("r3", "f", 10.0),
        ("rx", "g", 10.0),
        ("r1", "h", 10.0, {"trip_id": "ghost"}),
    )
    by_line = findings.on_time_by_line(facts, routes, min_count=1)
    assert rows(by_line.select("route_short_name", "pct_on_time", "n")) == [("T1", 50.0, 2)]
    assert findings.on_time_by_line(facts, routes, min_count=3).isEmpty()
    # 08:00 UTC is 18:00 in Sydney in September.
    assert rows(findings.on_time_by_hour(facts, routes, min_count=1).select("hour", "n")) == [(18, 2)]
    headline = one(findings.network_headline(facts, routes))
    assert tuple(headline) == (2, 50.0, pytest.approx(205 / 60))
    assert rows(findings.coverage_by_day(facts)) == [("20260916", 7, 1)]
    heat = findings.day_hour_heatmap(facts, routes, mode=None)
    assert rows(heat.select("day_of_week", "hour", "n")) == [(4, 18, 3)]


def test_headline_of_nothing(spark, routes):
    got = one(findings.network_headline(fact(spark, ("r3", "a", 1.0)), routes))
    assert tuple(got) == (0, None, None)


def test_kpis(spark):
    got = one(
        findings.delay_kpis(
            fact(
                spark,
                ("r1", "a", 10.0),
                ("r1", "b", 20.0),
                ("r1", "c", 20.0),
                ("r1", "d", 1000.0, {"schedule_relationship": "CANCELED"}),
                ("r1", "e", None),
                ("r1", "f", 5000.0, {"trip_id": "ghost"}),
            )
        )
    )
    assert tuple(got) == (5, 60.0, 262.5, 20.0, 20.0, 16.67)


def test_stop_products(spark):
    facts = fact(spark, ("r1", "a", 10.0), ("r1", "b", 400.0), ("r1", "b", 400.0, {"trip_id": "ghost"}))
    stops = star.dim_stop(
        spark.createDataFrame(
            [("a", "A", 1.0, 2.0, None), ("b", "B", 1.0, 2.0, None)],
            "stop_id string, stop_name string, stop_lat double, stop_lon double, parent_station string",
        )
    )
    daily = marts.stop_daily_performance(facts, stops)
    assert rows(daily.select("stop_id", "trip_stop_count", "pct_on_time")) == [("a", 1, 100.0), ("b", 1, 0.0)]
    ranking = findings.stop_ranking(facts, stops, min_count=1)
    assert [r.stop_id for r in findings.worst_stops(ranking, 1).collect()] == ["b"]


def test_top_products(spark, routes):
    mart = marts.line_delay_concentration(
        fact(spark, ("r1", "a", 300.0), ("r3", "b", 100.0)), routes
    )
    assert tuple(one(findings.top_concentration(mart, 1))) == (1, 75.0)
    assert [r[0] for r in findings.pareto_table(mart).collect()] == ["T1", "T2"]
    daily = marts.route_daily_performance(
        fact(spark, ("r1", "a", 400.0), ("r3", "b", 100.0)), routes
    )
    assert [r.route_id for r in findings.worst_route_days(daily, 1).collect()] == ["r1"]


def test_alerts_by_cause(spark):
    _, alerts = alert_case(spark)
    assert rows(findings.alerts_by_cause(alerts)) == [("MAINTENANCE", 5)]
