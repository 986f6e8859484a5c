"""The data products, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.adapt import Transit
from checks.registry import query, wall_clock
from headway.operators.latest import latest_per_key
from headway.plans import findings, marts, risk, silver, staging, star
from headway.session import scratch_dir
from headway.sinks.tables import write_table

# The published floors empty every group at the smallest scale; the queries use these.
MIN_GROUP = 50
MIN_STOP = 30
#: Depth of the forests that the queries fit; the job's own go as deep as Spark grows them.
QUERY_DEPTH = 10


@query
def stg_trip_updates(t: Transit) -> DataFrame:
    return wall_clock(t.updates.drop("arrival_time", "departure_time"))


@query
def stg_service_alerts(t: Transit) -> DataFrame:
    return wall_clock(t.alerts.drop("stop_id", "trip_id"))


@query
def stg_routes(t: Transit) -> DataFrame:
    return wall_clock(staging.static_table("routes", t.bronze_routes))


@query
def stg_stops(t: Transit) -> DataFrame:
    return wall_clock(t.stops.drop("parent_station"))


@query
def stg_trips(t: Transit) -> DataFrame:
    return wall_clock(staging.static_table("trips", t.bronze_trips))


@query
def stg_stop_times(t: Transit) -> DataFrame:
    return wall_clock(t.stop_times)


@query
def stg_calendar(t: Transit) -> DataFrame:
    calendar = staging.static_table("calendar", t.bronze_calendar)
    return calendar.drop("_feed_version", "_ingested_at")


@query
def trip_stop_performance(t: Transit) -> DataFrame:
    return wall_clock(silver.trip_stop_performance(t.updates, t.trips, t.stop_times))


@query
def silver_summary(t: Transit) -> DataFrame:
    return silver.silver_summary(t.matched)


@query
def dim_date(t: Transit) -> DataFrame:
    return wall_clock(star.dim_date(t.bronze_calendar))


@query
def dim_route(t: Transit) -> DataFrame:
    return t.dim_route.drop("route_key")


@query
def dim_stop(t: Transit) -> DataFrame:
    return t.dim_stop.drop("stop_key", "parent_station")


@query
def dim_trip(t: Transit) -> DataFrame:
    trips = staging.static_table("trips", t.bronze_trips)
    return star.dim_trip(trips).drop("trip_key", "route_key")


@query
def fact_trip_stop_performance(t: Transit) -> DataFrame:
    return wall_clock(t.fact.drop("route_key", "stop_key"))


@query
def fact_service_alerts(t: Transit) -> DataFrame:
    return wall_clock(t.fact_alerts.drop("route_key"))


@query
def surrogate_keys(t: Transit) -> DataFrame:
    keys = t.fact.groupBy("route_key", "stop_key").agg(F.count(F.lit(1)).alias("n"))
    return keys.join(t.dim_route.select("route_key", "route_id"), "route_key", "left")


@query
def route_daily_performance(t: Transit) -> DataFrame:
    return marts.route_daily_performance(t.fact, t.dim_route)


@query
def stop_daily_performance(t: Transit) -> DataFrame:
    return marts.stop_daily_performance(t.fact, t.dim_stop)


@query
def line_delay_concentration(t: Transit) -> DataFrame:
    return marts.line_delay_concentration(t.fact, t.dim_route)


@query
def alert_delay_impact(t: Transit) -> DataFrame:
    return marts.alert_delay_impact(t.fact, t.dim_route, t.fact_alerts)


@query
def delay_around_alerts(t: Transit) -> DataFrame:
    return marts.delay_around_alerts(t.fact, t.fact_alerts)


@query
def coverage_by_day(t: Transit) -> DataFrame:
    return findings.coverage_by_day(t.fact)


@query
def pareto_table(t: Transit) -> DataFrame:
    return findings.pareto_table(marts.line_delay_concentration(t.fact, t.dim_route))


@query
def top_concentration(t: Transit) -> DataFrame:
    return findings.top_concentration(marts.line_delay_concentration(t.fact, t.dim_route))


@query
def on_time_by_line(t: Transit) -> DataFrame:
    return findings.on_time_by_line(t.fact, t.dim_route, mode=None, min_count=MIN_GROUP)


@query
def on_time_by_hour(t: Transit) -> DataFrame:
    return findings.on_time_by_hour(t.fact, t.dim_route, mode=None, min_count=MIN_GROUP)


@query
def day_hour_heatmap(t: Transit) -> DataFrame:
    return findings.day_hour_heatmap(t.fact, t.dim_route, mode=None)


@query
def network_headline(t: Transit) -> DataFrame:
    return findings.network_headline(t.fact, t.dim_route)


@query
def worst_route_days(t: Transit) -> DataFrame:
    return findings.worst_route_days(marts.route_daily_performance(t.fact, t.dim_route))


@query
def biggest_alert_lifts(t: Transit) -> DataFrame:
    return findings.biggest_alert_lifts(
        marts.alert_delay_impact(t.fact, t.dim_route, t.fact_alerts)
    )


@query
def stop_ranking(t: Transit) -> DataFrame:
    return findings.stop_ranking(t.fact, t.dim_stop, min_count=MIN_STOP)


@query
def worst_stops(t: Transit) -> DataFrame:
    return findings.worst_stops(findings.stop_ranking(t.fact, t.dim_stop, min_count=MIN_STOP))


@query
def delay_kpis(t: Transit) -> DataFrame:
    return findings.delay_kpis(t.fact)


@query
def alerts_by_cause(t: Transit) -> DataFrame:
    return findings.alerts_by_cause(t.fact_alerts)


@query
def risk_training_set(t: Transit) -> DataFrame:
    return wall_clock(
        risk.training_set(t.fact, t.dim_route, t.fact_alerts, horizon=t.horizon)
    )


@query
def risk_recent_delay(t: Transit) -> DataFrame:
    recent = risk.recent_delay(t.fact)
    named = recent.join(t.dim_route.select("route_key", "route_id"), "route_key")
    return wall_clock(named.drop("route_key"))


@query
def risk_training_set_recent(t: Transit) -> DataFrame:
    recent = risk.recent_delay(t.fact)
    rows = risk.training_set(t.fact, t.dim_route, t.fact_alerts, horizon=t.horizon, recent=recent)
    return wall_clock(rows)


@query
def risk_split(t: Transit) -> DataFrame:
    rows = risk.training_set(t.fact, t.dim_route, t.fact_alerts, horizon=t.horizon)
    return risk.mark_test_rows(rows).groupBy("service_date", "is_test").agg(
        F.count(F.lit(1)).alias("n"), F.sum("had_active_alert").alias("with_alert")
    )


@query
def risk_class_weights(t: Transit) -> DataFrame:
    return risk.class_weights(
        risk.training_set(t.fact, t.dim_route, t.fact_alerts, horizon=t.horizon)
    )


def _trained(t: Transit) -> tuple[DataFrame, risk.Selection]:
    rows = risk.training_set(t.fact, t.dim_route, t.fact_alerts, horizon=t.horizon)
    return risk.train_and_select(rows, risk.candidates(max_depth=QUERY_DEPTH))


@query
def risk_class_report(t: Transit) -> DataFrame:
    rows, selection = _trained(t)
    report = risk.class_report(selection.model.transform(rows.filter("is_test")))
    return report.select(
        "*",
        F.lit(selection.name).alias("model_name"),
        *[F.lit(auc).alias(f"auc_{name}") for name, auc in selection.auc.items()],
    )


@query
def risk_scores(t: Transit) -> DataFrame:
    rows, selection = _trained(t)
    return risk.score(rows, selection)


@query
def risk_score_table(t: Transit) -> DataFrame:
    """What the score table holds by day and label after it was replaced: every row once, one model, chances from 0 to 1."""
    rows, selection = _trained(t)
    path = scratch_dir(rows.sparkSession, "scores")
    write_table(rows, path)
    write_table(risk.score(rows, selection), path)
    chance = F.col("predicted_delay_risk")
    return (
        rows.sparkSession.read.parquet(path)
        .groupBy("service_date", F.col("actual_is_late").alias("is_late"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(chance.between(0, 1)).alias("chances"),
            F.count_distinct("model_name").alias("models"),
        )
    )


@query
def version_aware_match(t: Transit) -> DataFrame:
    """Live trips against the order history: a month's orders are the timetable version of that month."""
    month = F.date_format("_ingested_at", "yyyyMM")
    history = t.bronze_trips.withColumn("_feed_version", month)
    trip_versions = latest_per_key(
        history,
        ["_feed_version", "trip_id"],
        [F.col("_ingested_at").desc(), F.col("trip_headsign"), F.col("service_id")],
    )
    versions = history.select(
        "_feed_version", F.concat("_feed_version", F.lit("01")).alias("valid_from")
    ).distinct()
    matched = silver.match_trips_by_version(
        silver.latest_snapshot(t.updates), trip_versions, versions, silver.service_dates(t.updates)
    )
    return matched.select(
        "trip_id",
        "stop_id",
        "service_date",
        "_feed_version",
        "trip_headsign",
        "service_id",
        "is_orphan_trip",
    )
