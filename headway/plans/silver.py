"""Silver: live records, deduplicated and reconciled with the timetable."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway import constants as C
from headway.functions import columns as fx
from headway.functions.shares import count_true
from headway.operators.latest import latest_per_key


def latest_snapshot(updates: DataFrame) -> DataFrame:
    """The newest report of each stop of each trip on each service date.

    The service date is part of the key because trip ids come back on other days, and the stop is
    because some trips report sequence 0 everywhere.
    """
    dated = updates.withColumn(
        "service_date", fx.service_date(F.col("start_date"), F.col("feed_timestamp"))
    )
    order = [F.col("_ingested_at").desc(), F.col("feed_timestamp").desc(), F.col("entity_id").desc()]
    return latest_per_key(dated, C.FACT_GRAIN, order)


def match_trips(
    snapshot: DataFrame,
    trips: DataFrame,
    *,
    on: Sequence[str] = ("trip_id",),
    delay_low: int = C.PLAUSIBLE_DELAY_LOW_SECONDS,
    delay_high: int = C.PLAUSIBLE_DELAY_HIGH_SECONDS,
) -> DataFrame:
    """Look up each trip in the timetable, keeping and flagging those it does not have.

    `trips` must have one row per `on`.
    """
    static = trips.select(
        *[F.col(c).alias(f"_static_{c}") for c in on], "trip_headsign", "service_id"
    )
    same = reduce(and_, [F.col(c) == F.col(f"_static_{c}") for c in on])
    return snapshot.join(static, same, "left").select(
        *snapshot.columns,
        "trip_headsign",
        "service_id",
        F.col("_static_trip_id").isNull().alias("is_orphan_trip"),
        fx.is_delay_outlier(F.col("arrival_delay_seconds"), delay_low, delay_high).alias(
            "is_delay_outlier"
        ),
    )


def attach_schedule(matched: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Add scheduled times by (trip_id, stop_sequence), and whether the timetable has the same stop
    there: sequences are not reliable on every trip."""
    schedule = stop_times.select(
        F.col("trip_id").alias("_st_trip_id"),
        F.col("stop_sequence").alias("_st_sequence"),
        F.col("stop_id").alias("_st_stop_id"),
        F.col("arrival_time").alias("scheduled_arrival_time_of_day"),
        F.col("departure_time").alias("scheduled_departure_time_of_day"),
    )
    on = (F.col("trip_id") == F.col("_st_trip_id")) & (
        F.col("stop_sequence") == F.col("_st_sequence")
    )
    return matched.join(schedule, on, "left").withColumn(
        "schedule_stop_matches", F.col("stop_id") == F.col("_st_stop_id")
    )


def trip_stop_performance(
    updates: DataFrame,
    trips: DataFrame,
    stop_times: DataFrame,
    *,
    delay_low: int = C.PLAUSIBLE_DELAY_LOW_SECONDS,
    delay_high: int = C.PLAUSIBLE_DELAY_HIGH_SECONDS,
) -> DataFrame:
    matched = match_trips(
        latest_snapshot(updates), trips, delay_low=delay_low, delay_high=delay_high
    )
    return attach_schedule(matched, stop_times).select(
        "trip_id",
        "route_id",
        "stop_id",
        "stop_sequence",
        "service_date",
        "schedule_relationship",
        "arrival_delay_seconds",
        "departure_delay_seconds",
        "scheduled_arrival_time_of_day",
        "scheduled_departure_time_of_day",
        "trip_headsign",
        "service_id",
        "is_orphan_trip",
        "is_delay_outlier",
        "schedule_stop_matches",
        "feed_timestamp",
        "_ingested_at",
    )


def silver_summary(silver: DataFrame) -> DataFrame:
    delay = F.col("arrival_delay_seconds")
    seconds = fx.whole_seconds(delay)
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_true(F.col("is_orphan_trip")).alias("orphan_rows"),
        count_true(F.col("is_delay_outlier")).alias("outlier_rows"),
        F.round(fx.ratio(F.sum(seconds), F.count(seconds)), 1).alias("avg_arrival_delay_seconds"),
        F.min(delay).alias("min_arrival_delay_seconds"),
        F.max(delay).alias("max_arrival_delay_seconds"),
    )


def service_dates(updates: DataFrame) -> DataFrame:
    """The service dates of the updates, told from two columns, before anything is deduplicated."""
    return updates.select(fx.service_date(F.col("start_date"), F.col("feed_timestamp")).alias("service_date")).distinct()


def versions_by_date(dates: DataFrame, versions: DataFrame) -> DataFrame:
    """The timetable version in force on each of `dates` (service_date, distinct): the last one that began on or before it, of
    several that began together the largest, or the first version for earlier dates and for none.

    `versions` has rows (_feed_version, valid_from yyyyMMdd); those without valid_from are never in force. What is put in order
    here are days, those on which a version began and those of service, so one task takes them all.
    """
    begun = versions.filter("valid_from IS NOT NULL").groupBy(F.col("valid_from").alias("service_date"))
    begun = begun.agg(F.max("_feed_version").alias("_feed_version"), F.min("_feed_version").alias("_least"))
    days = begun.withColumn("_asked", F.lit(0)).unionByName(dates.select("service_date", F.lit(1).alias("_asked")), allowMissingColumns=True)
    order = Window.orderBy("service_date", "_asked")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    in_force = F.coalesce(F.last("_feed_version", True).over(so_far), F.first("_least", True).over(everything))
    return days.select("service_date", "_asked", in_force.alias("_feed_version")).filter("_asked = 1").drop("_asked")


def with_version_on_date(
    snapshot: DataFrame, versions: DataFrame, dates: DataFrame | None = None
) -> DataFrame:
    """Add the timetable version in force on the service date, looked up by equality in a table of days.

    `dates` spares a second pass over the snapshot: all its service dates (service_date, distinct), and maybe more.
    """
    if dates is None:
        dates = snapshot.select("service_date").distinct()
    by_date = versions_by_date(dates, versions).withColumnRenamed("service_date", "_version_date")
    same = F.col("service_date").eqNullSafe(F.col("_version_date"))
    return snapshot.join(by_date, same, "left").drop("_version_date")


def match_trips_by_version(
    snapshot: DataFrame,
    trip_versions: DataFrame,
    versions: DataFrame,
    dates: DataFrame | None = None,
    **delay_bounds: int,
) -> DataFrame:
    """match_trips against the timetable version in force on the service date instead of the newest.

    `trip_versions` has one row per (_feed_version, trip_id).
    """
    dated = with_version_on_date(snapshot, versions, dates)
    return match_trips(dated, trip_versions, on=("_feed_version", "trip_id"), **delay_bounds)
