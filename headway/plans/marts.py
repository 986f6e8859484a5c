"""Marts. Facts are aggregated to their keys before any join, so dimension joins meet aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import ratio
from headway.functions.shares import (
    combine_partials,
    mean_delay,
    pct_on_time,
    punctuality_partials,
)
from headway.operators.intervals import interval_totals
from headway.operators.ranking import cumulative_share

_DELAY = "arrival_delay_seconds"

# Groupings under which the fact may be kept as totals, per service date. Every mart takes either the fact
# or the totals of its grouping, so that a full-history mart need not read the whole fact again.
DAY_TOTALS = ["service_date", "date_key", "route_key", "stop_key", "is_orphan_trip"]
INSTANT_TOTALS = ["service_date", "route_key", "feed_timestamp", "is_orphan_trip"]


def totals(source: DataFrame, *keys: str) -> DataFrame:
    """Punctuality sums per key, of the fact or of stored totals of a finer grouping."""
    stored = "trip_stop_count" in source.columns
    sums = combine_partials() if stored else punctuality_partials()
    return source.groupBy(*keys).agg(*sums)


def _matched(source: DataFrame) -> DataFrame:
    return source.filter(~F.col("is_orphan_trip"))


def _daily_performance(
    source: DataFrame, key: str, dim: DataFrame, attributes: list[str]
) -> DataFrame:
    per_key = totals(_matched(source), "date_key", key)
    grain = ["date_key", *attributes]
    return totals(per_key.join(dim.select(key, *attributes), key), *grain).select(
        *grain,
        "trip_stop_count",
        "late_count",
        "cancelled_count",
        F.round(pct_on_time(), 1).alias("pct_on_time"),
        F.round(mean_delay(), 1).alias("avg_arrival_delay_seconds"),
    )


def route_daily_performance(fact: DataFrame, dim_route: DataFrame) -> DataFrame:
    """Punctuality per route and day, without non-revenue routes (those with no short name)."""
    revenue = dim_route.filter(F.col("route_short_name").isNotNull())
    attributes = ["route_id", "route_short_name", "mode"]
    return _daily_performance(fact, "route_key", revenue, attributes)


def stop_daily_performance(fact: DataFrame, dim_stop: DataFrame) -> DataFrame:
    return _daily_performance(fact, "stop_key", dim_stop, ["stop_id", "stop_name"])


def line_delay_concentration(fact: DataFrame, dim_route: DataFrame) -> DataFrame:
    """Total positive delay per line, its share of the network and the running share."""
    per_route = totals(_matched(fact), "route_key")
    revenue = dim_route.filter(F.col("route_short_name").isNotNull())
    named = per_route.join(revenue.select("route_key", "route_short_name", "mode"), "route_key")
    lines = totals(named, "route_short_name", "mode").select(
        "route_short_name", "mode", "late_seconds", "trip_stop_count"
    )
    tie_break = ["route_short_name", "mode"]
    shares = cumulative_share(lines, "late_seconds", tie_break, "share", "running")
    seconds = F.col("late_seconds").cast("double")
    return shares.select(
        "route_short_name",
        "mode",
        seconds.alias("total_delay_seconds"),
        F.round(seconds / 60.0, 1).alias("total_delay_minutes"),
        "trip_stop_count",
        F.round("share", 1).alias("pct_of_network_delay"),
        F.round("running", 1).alias("cumulative_pct_of_network_delay"),
    )


def _closed_windows(alerts: DataFrame) -> DataFrame:
    return (
        alerts.filter(
            F.col("active_period_start").isNotNull() & F.col("active_period_end").isNotNull()
        )
        .select(
            "route_key",
            "route_id",
            "header_text",
            "cause",
            "effect",
            "active_period_start",
            "active_period_end",
        )
        .distinct()
    )


_ALERT = ["route_id", "header_text", "cause", "effect"]


def _delay_in_windows(
    fact: DataFrame, windows: DataFrame, group: list[str], **window_columns
) -> DataFrame:
    instants = totals(_matched(fact), "route_key", "feed_timestamp")
    return interval_totals(
        instants,
        windows,
        key="route_key",
        at="feed_timestamp",
        group=["route_key", *group],
        weight=F.col("trip_stop_count"),
        measures={"delay_count": F.col("delay_count"), "delay_sum": F.col("delay_sum")},
        **window_columns,
    )


def alert_delay_impact(fact: DataFrame, dim_route: DataFrame, alerts: DataFrame) -> DataFrame:
    """Mean delay while each alert was open against the same route's mean over all history.

    Overlapping windows of one alert text count a row once each. Always read the lift together with
    its observation count.
    """
    during = _delay_in_windows(
        fact,
        _closed_windows(alerts),
        _ALERT,
        start="active_period_start",
        end="active_period_end",
    )
    mean = ratio(F.col("delay_sum"), F.col("delay_count"))
    baseline = ratio(F.col("delay_sum_total"), F.col("delay_count_total"))
    # Only routes of the timetable have a baseline.
    return during.join(dim_route.select("route_key"), "route_key", "left_semi").select(
        *_ALERT,
        F.col("point_count").alias("observations_during_alert"),
        F.round(mean, 1).alias("avg_delay_during_alert_seconds"),
        F.round(baseline, 1).alias("baseline_avg_delay_seconds"),
        F.round(mean - baseline, 1).alias("delay_lift_seconds"),
    )


def delay_around_alerts(
    fact: DataFrame, alerts: DataFrame, *, margin: str = "2 hours"
) -> DataFrame:
    """Mean delay in the `margin` before each alert window, in it, and in the `margin` after it."""
    gap = F.expr(f"interval {margin}")
    start, end = F.col("active_period_start"), F.col("active_period_end")

    def part(phase: str, lo: Column, hi: Column, lo_in: bool, hi_in: bool) -> Column:
        return F.struct(
            F.lit(phase).alias("phase"),
            lo.alias("lo"),
            hi.alias("hi"),
            F.lit(lo_in).alias("lo_in"),
            F.lit(hi_in).alias("hi_in"),
        )

    parts = (
        _closed_windows(alerts)
        .filter(start <= end)
        .select(
            "route_key",
            *_ALERT,
            F.inline(
                F.array(
                    part("before", start - gap, start, True, False),
                    part("during", start, end, True, True),
                    part("after", end, end + gap, False, True),
                )
            ),
        )
    )
    totals = _delay_in_windows(
        fact,
        parts,
        [*_ALERT, "phase"],
        start="lo",
        end="hi",
        bounds=(F.col("lo_in"), F.col("hi_in")),
    )
    return totals.select(
        *_ALERT,
        "phase",
        F.col("point_count").alias("observations"),
        F.round(ratio(F.col("delay_sum"), F.col("delay_count")), 1).alias("avg_delay_seconds"),
    )
