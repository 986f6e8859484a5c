"""Findings: the questions an operator asks of the marts and the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import constants as C
from headway.functions.columns import pct
from headway.functions.shares import (
    combine_partials,
    count_true,
    mean_delay,
    pct_on_time,
    punctuality_partials,
)
from headway.operators.ranking import top_n


def coverage_by_day(fact: DataFrame) -> DataFrame:
    orphan = F.col("is_orphan_trip")
    return fact.groupBy("service_date").agg(
        F.count_if(~orphan).alias("matched"), count_true(orphan).alias("orphan")
    )


def _scored(fact: DataFrame) -> DataFrame:
    """Reconciled, plausible, not cancelled. A null flag excludes the row."""
    return fact.filter(
        ~F.col("is_orphan_trip") & ~F.col("is_delay_outlier") & ~F.col("is_cancelled")
    )


def _passenger_lines(dim_route: DataFrame, mode: str | None) -> DataFrame:
    named = dim_route.filter(F.col("route_short_name").isNotNull())
    return named if mode is None else named.filter(F.col("mode") == mode)


def _scored_partials(
    fact: DataFrame, dim_route: DataFrame, mode: str | None, by: list[Column]
) -> DataFrame:
    """Punctuality partials of the scored population per route and `by`, with the line's name."""
    per_route = _scored(fact).groupBy("route_key", *by).agg(*punctuality_partials())
    lines = _passenger_lines(dim_route, mode).select("route_key", "route_short_name")
    return per_route.join(lines, "route_key")


def on_time_by_line(
    fact: DataFrame,
    dim_route: DataFrame,
    *,
    mode: str | None = "train",
    min_count: int = C.MIN_GROUP_SIZE,
) -> DataFrame:
    return (
        _scored_partials(fact, dim_route, mode, [])
        .groupBy("route_short_name")
        .agg(*combine_partials())
        .filter(F.col("trip_stop_count") >= min_count)
        .select(
            "route_short_name",
            pct_on_time().alias("pct_on_time"),
            (mean_delay() / 60.0).alias("avg_delay_minutes"),
            F.col("trip_stop_count").alias("n"),
        )
    )


def _by_time(
    fact: DataFrame, dim_route: DataFrame, mode: str | None, min_count: int, parts: dict[str, Column]
) -> DataFrame:
    return (
        _scored_partials(fact, dim_route, mode, [c.alias(n) for n, c in parts.items()])
        .groupBy(*parts)
        .agg(*combine_partials())
        .filter(F.col("trip_stop_count") >= min_count)
        .select(
            *parts,
            pct_on_time().alias("pct_on_time"),
            (mean_delay() / 60.0).alias("avg_delay_minutes"),
            F.col("trip_stop_count").alias("n"),
        )
    )


def on_time_by_hour(
    fact: DataFrame,
    dim_route: DataFrame,
    *,
    mode: str | None = "train",
    tz: str = C.LOCAL_TIME_ZONE,
    min_count: int = C.MIN_GROUP_SIZE,
) -> DataFrame:
    local = F.from_utc_timestamp("feed_timestamp", tz)
    return _by_time(fact, dim_route, mode, min_count, {"hour": F.hour(local)})


def day_hour_heatmap(
    fact: DataFrame,
    dim_route: DataFrame,
    *,
    mode: str | None = "train",
    tz: str = C.LOCAL_TIME_ZONE,
    min_count: int = 1,
) -> DataFrame:
    """Punctuality per local day of week (1 = Sunday) and hour."""
    local = F.from_utc_timestamp("feed_timestamp", tz)
    parts = {"day_of_week": F.dayofweek(local), "hour": F.hour(local)}
    return _by_time(fact, dim_route, mode, min_count, parts)


def network_headline(
    fact: DataFrame, dim_route: DataFrame, *, mode: str | None = "train"
) -> DataFrame:
    return (
        _scored_partials(fact, dim_route, mode, [])
        .agg(*combine_partials())
        .select(
            F.coalesce("trip_stop_count", F.lit(0)).alias("stops_scored"),
            F.round(pct_on_time(), 1).alias("pct_on_time"),
            (mean_delay() / 60.0).alias("avg_delay_minutes"),
        )
    )


def pareto_table(concentration: DataFrame) -> DataFrame:
    """The concentration mart as presented: worst line first."""
    return concentration.select(
        "route_short_name", "total_delay_minutes", "cumulative_pct_of_network_delay"
    ).orderBy(F.col("total_delay_minutes").desc(), "route_short_name")


def top_concentration(concentration: DataFrame, n: int = 4) -> DataFrame:
    """What the n worst lines add up to."""
    worst = top_n(
        concentration, [F.col("total_delay_seconds").desc(), F.col("route_short_name").asc()], n
    )
    return worst.agg(
        F.count(F.lit(1)).alias("lines"),
        F.max("cumulative_pct_of_network_delay").alias("pct_of_network_delay"),
    )


def worst_route_days(daily: DataFrame, n: int = 10) -> DataFrame:
    order = [F.col("pct_on_time").asc(), F.col("date_key").asc(), F.col("route_id").asc()]
    return top_n(daily, order, n)


def biggest_alert_lifts(impact: DataFrame, n: int = 10) -> DataFrame:
    keys = ["route_id", "header_text", "cause", "effect"]
    order = [F.col("delay_lift_seconds").desc_nulls_last(), *[F.col(k).asc() for k in keys]]
    return top_n(impact, order, n)


def stop_ranking(
    fact: DataFrame, dim_stop: DataFrame, *, min_count: int = C.MIN_STOP_OBSERVATIONS
) -> DataFrame:
    """Punctuality per stop with enough scored observations to be more than noise."""
    per_stop = (
        _scored(fact)
        .groupBy("stop_key")
        .agg(*punctuality_partials())
        .filter(F.col("trip_stop_count") >= min_count)
    )
    return per_stop.join(dim_stop.select("stop_key", "stop_id", "stop_name"), "stop_key").select(
        "stop_id",
        "stop_name",
        F.round(pct_on_time(), 1).alias("pct_on_time"),
        F.round(mean_delay(), 1).alias("avg_delay_seconds"),
        F.col("trip_stop_count").alias("n"),
    )


def worst_stops(ranking: DataFrame, n: int = 10) -> DataFrame:
    return top_n(ranking, [F.col("pct_on_time").asc(), F.col("stop_id").asc()], n)


def delay_kpis(fact: DataFrame) -> DataFrame:
    """Mean and median delay, punctuality, cancellation and coverage of the whole fact.

    Rows are first counted per distinct whole-second delay, so the exact median weighs at most one
    entry per second of the plausible range.
    """
    matched = ~F.col("is_orphan_trip")
    per_delay = fact.groupBy("arrival_delay_seconds").agg(
        F.count_if(matched).alias("n"),
        F.count_if(matched & F.col("is_late")).alias("late"),
        F.count_if(matched & F.col("is_cancelled")).alias("cancelled"),
        F.count_if(~matched).alias("orphan"),
    )
    delay = F.col("arrival_delay_seconds")
    known = F.when(delay.isNotNull(), F.col("n")).otherwise(0)
    total = F.sum("n")
    return per_delay.agg(
        total.alias("trip_stop_count"),
        F.round(pct(F.sum(known) - F.sum("late"), total), 1).alias("pct_on_time"),
        F.round(
            F.try_divide(F.sum(delay.cast("bigint") * F.col("n")).cast("double"), F.sum(known)), 1
        ).alias("avg_delay_seconds"),
        F.percentile(delay, F.lit(0.5), known).alias("median_delay_seconds"),
        F.round(pct(F.sum("cancelled"), total), 2).alias("pct_cancelled"),
        F.round(pct(F.sum("orphan"), total + F.sum("orphan")), 2).alias("pct_orphan"),
    )


def alerts_by_cause(alerts: DataFrame) -> DataFrame:
    """Distinct alerts per cause."""
    return alerts.select("alert_id", "cause").distinct().groupBy("cause").agg(
        F.count(F.lit(1)).alias("alert_count")
    )
