"""Aggregate expressions shared by the marts. Each is a sum or a count, so it combines on the map side and
partial results can be added up again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.columns import pct, ratio, whole_seconds


def count_true(flag: Column) -> Column:
    return F.count_if(flag)


def punctuality_partials(delay: str = "arrival_delay_seconds") -> list[Column]:
    """Counts and sums from which every punctuality measure is built."""
    seconds = whole_seconds(F.col(delay))
    return [
        F.count(F.lit(1)).alias("trip_stop_count"),
        F.count("is_late").alias("scored_count"),
        count_true(F.col("is_late")).alias("late_count"),
        count_true(F.col("is_cancelled")).alias("cancelled_count"),
        F.sum(seconds).alias("delay_sum"),
        F.count(seconds).alias("delay_count"),
        # An early or unknown arrival adds nothing.
        F.sum(F.greatest(seconds, F.lit(0).cast("bigint"))).alias("late_seconds"),
    ]


def combine_partials() -> list[Column]:
    names = (
        "trip_stop_count",
        "scored_count",
        "late_count",
        "cancelled_count",
        "delay_sum",
        "delay_count",
        "late_seconds",
    )
    return [F.sum(n).alias(n) for n in names]


def pct_on_time() -> Column:
    """Share of all rows known to be on time: a row without a delay counts as not on time."""
    return pct(F.col("scored_count") - F.col("late_count"), F.col("trip_stop_count"))


def mean_delay() -> Column:
    return ratio(F.col("delay_sum"), F.col("delay_count"))


def delay_measures(delay: str) -> dict[str, Column]:
    """Per row, what a mean delay adds up."""
    seconds = whole_seconds(F.col(delay))
    return {"delay_count": seconds.isNotNull().cast("bigint"), "delay_sum": seconds}
