"""Column expressions: flags, keys, dates, enum names and ratios."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway import constants as C


def epoch_timestamp(seconds: Column) -> Column:
    """Epoch seconds to timestamp; zero means the field was never set."""
    return F.timestamp_seconds(F.nullif(seconds, F.lit(0)))


def enum_name(code: Column, names: Mapping[int, str]) -> Column:
    """Wire code to name; unset or unknown codes read as the enum's first listed name."""
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in names.items()))
    return F.coalesce(F.try_element_at(lookup, code), F.lit(next(iter(names.values()))))


def service_date(start_date: Column, feed_timestamp: Column) -> Column:
    """The feed's own start date, or the feed day where it is blank."""
    return F.coalesce(
        F.nullif(start_date, F.lit("")), F.date_format(feed_timestamp, "yyyyMMdd")
    )


def date_key(service_date_: Column) -> Column:
    return service_date_.try_cast("int")


def is_late(delay: Column, threshold: int = C.ON_TIME_THRESHOLD_SECONDS) -> Column:
    """Strictly over the threshold; null where the delay is unknown."""
    return delay > threshold


def is_cancelled(schedule_relationship: Column) -> Column:
    return schedule_relationship == "CANCELED"


def is_delay_outlier(
    delay: Column,
    low: int = C.PLAUSIBLE_DELAY_LOW_SECONDS,
    high: int = C.PLAUSIBLE_DELAY_HIGH_SECONDS,
) -> Column:
    return (delay < low) | (delay > high)


def mode(route_type: Column) -> Column:
    branch = F
    for code, name in C.MODE_BY_ROUTE_TYPE.items():
        branch = branch.when(route_type == code, name)
    return branch.otherwise(C.OTHER_MODE)


def surrogate_key(natural_key: Column) -> Column:
    return F.xxhash64(natural_key)


def whole_seconds(delay: Column) -> Column:
    """Feed delays are 32-bit whole seconds carried as doubles. Summing them as integers gives the
    same total in every partitioning and merge order."""
    return delay.cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, null for an empty denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))
