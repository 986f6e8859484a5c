"""Star schema: dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import constants as C
from headway.functions import columns as fx


def dim_date(calendar: DataFrame) -> DataFrame:
    """Every day from the first start to the last end of the service calendar."""
    bounds = calendar.agg(F.min("start_date").alias("lo"), F.max("end_date").alias("hi"))
    first, last = (F.try_to_date(c, "yyyyMMdd") for c in ("lo", "hi"))
    days = bounds.select(F.explode(F.sequence(first, last)).alias("full_date"))
    return days.select(
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.date_format("full_date", "EEEE").alias("day_of_week"),
        (~F.dayofweek("full_date").isin(1, 7)).alias("is_weekday"),
    )


def dim_route(routes: DataFrame) -> DataFrame:
    return routes.select(
        fx.surrogate_key(F.col("route_id")).alias("route_key"),
        "route_id",
        "route_short_name",
        "route_long_name",
        fx.mode(F.col("route_type")).alias("mode"),
        F.col("agency_id").alias("operator"),
    )


def dim_stop(stops: DataFrame) -> DataFrame:
    return stops.select(
        fx.surrogate_key(F.col("stop_id")).alias("stop_key"),
        "stop_id",
        "stop_name",
        "stop_lat",
        "stop_lon",
        "parent_station",
    )


def dim_trip(trips: DataFrame) -> DataFrame:
    """Scheduled trips with the timetable version each row belongs to."""
    return trips.select(
        fx.surrogate_key(F.col("trip_id")).alias("trip_key"),
        "trip_id",
        fx.surrogate_key(F.col("route_id")).alias("route_key"),
        F.col("trip_headsign").alias("headsign"),
        "service_id",
        F.col("_feed_version").alias("static_feed_version"),
    )


def fact_trip_stop(
    silver: DataFrame, *, on_time_threshold: int = C.ON_TIME_THRESHOLD_SECONDS
) -> DataFrame:
    """One row per (service_date, trip_id, stop_id, stop_sequence).

    Needs only the columns `match_trips` gives, so a fact build can skip the schedule join.
    """
    return silver.select(
        fx.date_key(F.col("service_date")).alias("date_key"),
        "service_date",
        fx.surrogate_key(F.col("route_id")).alias("route_key"),
        fx.surrogate_key(F.col("stop_id")).alias("stop_key"),
        "stop_id",
        "trip_id",
        "stop_sequence",
        "schedule_relationship",
        "arrival_delay_seconds",
        "departure_delay_seconds",
        fx.is_late(F.col("arrival_delay_seconds"), on_time_threshold).alias("is_late"),
        fx.is_cancelled(F.col("schedule_relationship")).alias("is_cancelled"),
        "is_orphan_trip",
        "is_delay_outlier",
        "feed_timestamp",
        "_ingested_at",
    )


def fact_service_alerts(alerts: DataFrame) -> DataFrame:
    """Distinct route-level alerts: every poll captures an open alert again."""
    return (
        alerts.filter(F.col("route_id").isNotNull() & (F.col("route_id") != ""))
        .select(
            "alert_id",
            "cause",
            "effect",
            "header_text",
            "description_text",
            "route_id",
            "active_period_start",
            "active_period_end",
        )
        .distinct()
        .select("*", fx.surrogate_key(F.col("route_id")).alias("route_key"))
    )
