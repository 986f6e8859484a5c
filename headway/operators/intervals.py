"""Windows of time against timed rows, per key, without forming the pairs.

`interval_totals` answers "sum these measures over the rows inside each window" from running totals,
so its cost is rows + windows however often they overlap. `flag_covered` answers "was any window open
at this row" from the united windows, cut into time buckets.

Times are cut into fixed buckets. One (key, bucket) is the unit a task works on, so a key that holds
a large share of the rows is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600
DAY = 24 * HOUR

# Where a window edge falls among rows of the same instant.
BEFORE_ROWS, ROWS, AFTER_ROWS = 0, 1, 2


def time_bucket(at: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(at) / F.lit(seconds * 1_000_000)).cast("bigint")


def _bucket_start(bucket: Column, seconds: int) -> Column:
    return F.timestamp_micros(bucket * F.lit(seconds * 1_000_000))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[Column],
    measures: Sequence[str],
    keep: Column | None = None,
) -> DataFrame:
    """Replace each measure by its running total in (bucket, order), per key, and add the key's whole total
    as <measure>_total.

    Totals run inside each (keys, bucket) first; what earlier buckets add is a running total over one
    row per bucket. `bucket` must not contradict `order`. Rows not in `keep` count but are not returned.
    """
    inside = (
        Window.partitionBy(*keys, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    buckets = Window.partitionBy(*keys).orderBy(bucket)
    earlier = buckets.rowsBetween(Window.unboundedPreceding, -1)
    every = buckets.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bucket_totals = df.groupBy(*keys, bucket).agg(*[F.sum(m).alias(m) for m in measures])
    carried = bucket_totals.select(
        *[F.col(k).alias(f"_of_{k}") for k in (*keys, bucket)],
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_carried_{m}") for m in measures],
        *[F.sum(m).over(every).alias(f"{m}_total") for m in measures],
    )
    others = [c for c in df.columns if c not in measures]
    rows = df.select(*others, *[F.sum(m).over(inside).alias(m) for m in measures])
    if keep is not None:
        rows = rows.filter(keep)
    same_bucket = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in (*keys, bucket)]
    return rows.join(carried, same_bucket).select(
        *others,
        *[(F.col(m) + F.col(f"_carried_{m}")).alias(m) for m in measures],
        *[f"{m}_total" for m in measures],
    )


def interval_totals(
    points: DataFrame,
    windows: DataFrame,
    *,
    key: str,
    at: str,
    start: str,
    end: str,
    group: Sequence[str],
    measures: Mapping[str, Column],
    weight: Column | None = None,
    bounds: tuple[bool | Column, bool | Column] = (True, True),
    bucket_seconds: int = HOUR,
) -> DataFrame:
    """Per `group` of windows, the number of points inside them and the sum of each whole-number measure.
    A row of `points` stands for `weight` points, one if not given.

    A point inside several windows of a group counts once for each. `bounds` says whether the start
    and the end belong to the window. Groups whose windows hold no point are left out. If `key` is in
    `group`, <measure>_total is the sum over all points of the key, in a window or not.

    A window's total is the running total at its end minus the one just before its start, so points
    are summed once per instant and the rows of one (key, bucket) are at most its distinct instants.
    """
    names = list(measures)
    instants = (
        points.filter(F.col(key).isNotNull())
        .groupBy(key, F.col(at).alias("_at"))
        .agg(
            F.sum(F.lit(1).cast("bigint") if weight is None else weight).alias("_points"),
            *[F.sum(m).alias(n) for n, m in measures.items()],
        )
    )
    # A point without a time sorts before every edge: it adds the same to both ends of each window.
    instants = instants.select(
        key,
        "_at",
        F.lit(ROWS).alias("_side"),
        "_points",
        *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names],
    )

    start_in, end_in = (b if isinstance(b, Column) else F.lit(b) for b in bounds)
    opening = F.struct(
        F.col(start).alias("at"),
        F.when(start_in, BEFORE_ROWS).otherwise(AFTER_ROWS).alias("side"),
        F.lit(-1).alias("sign"),
    )
    closing = F.struct(
        F.col(end).alias("at"),
        F.when(end_in, AFTER_ROWS).otherwise(BEFORE_ROWS).alias("side"),
        F.lit(1).alias("sign"),
    )
    ordered = (F.col(start) < F.col(end)) | ((F.col(start) == F.col(end)) & start_in & end_in)
    edges = windows.filter(F.col(key).isNotNull() & ordered).select(
        F.col(key).alias("_edge_key"),
        *[F.col(g).alias(f"_group_{g}") for g in group],
        F.inline(F.array(opening, closing)).alias("_edge_at", "_edge_side", "_sign"),
    )
    ticks = (
        edges.select(
            F.col("_edge_key").alias(key),
            F.col("_edge_at").alias("_at"),
            F.col("_edge_side").alias("_side"),
        )
        .distinct()
        .select("*", *[F.lit(0).cast("bigint").alias(m) for m in ("_points", *names)])
    )

    timeline = instants.unionByName(ticks).withColumn(
        "_bucket", time_bucket(F.col("_at"), bucket_seconds)
    )
    totals = running_totals(
        timeline,
        [key],
        "_bucket",
        [F.col("_at"), F.col("_side")],
        ["_points", *names],
        keep=F.col("_side") != ROWS,
    )
    at_edges = edges.join(
        totals,
        (F.col("_edge_key") == F.col(key))
        & (F.col("_edge_at") == F.col("_at"))
        & (F.col("_edge_side") == F.col("_side")),
    )
    whole = [F.max(f"{n}_total").alias(f"{n}_total") for n in names] if key in group else []
    return (
        at_edges.groupBy(*[F.col(f"_group_{g}").alias(g) for g in group])
        .agg(
            F.sum(F.col("_sign") * F.col("_points")).alias("point_count"),
            *[F.sum(F.col("_sign") * F.col(n)).alias(n) for n in names],
            *whole,
        )
        .filter(F.col("point_count") > 0)
    )


def _united(windows: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, _lo, _hi): windows united where they overlap or touch, within the rows of `keys`."""
    by_start = Window.partitionBy(*keys).orderBy("_lo", "_hi")
    reached = F.max("_hi").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("_lo") > reached, F.lit(True)).cast("int")
    so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    islands = windows.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(so_far))
    return islands.groupBy(*keys, "_island").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")).drop("_island")


def merged_windows(windows: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(_key, _lo, _hi): windows with both ends, united per key where they overlap or touch.

    Windows of one start are reduced to the longest, then those of one key that start on one day are united; only what
    is left of each day meets in the order of the whole key.
    """
    longest = (
        windows.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
        .groupBy(F.col(key).alias("_key"), F.col(start).alias("_lo"))
        .agg(F.max(end).alias("_hi"))
        .filter(F.col("_key").isNotNull())
    )
    by_day = _united(longest.withColumn("_day", time_bucket(F.col("_lo"), DAY)), ["_key", "_day"])
    return _united(by_day.drop("_day"), ["_key"])


def _clipped_pieces(
    merged: DataFrame, horizon: DataFrame, bucket_seconds: int
) -> DataFrame:
    """Cut merged windows at bucket borders, after clipping them to the one-row `horizon` (lo, hi)."""
    clipped = merged.select(
        "_key",
        F.greatest("_lo", horizon.select("lo").scalar()).alias("_lo"),
        F.least("_hi", horizon.select("hi").scalar()).alias("_hi"),
    ).filter(F.col("_lo") <= F.col("_hi"))
    bucket = F.col("_bucket")
    return clipped.select(
        "*",
        F.explode(
            F.sequence(
                time_bucket(F.col("_lo"), bucket_seconds), time_bucket(F.col("_hi"), bucket_seconds)
            )
        ).alias("_bucket"),
    ).select(
        "_key",
        "_bucket",
        F.greatest("_lo", _bucket_start(bucket, bucket_seconds)).alias("lo"),
        F.least("_hi", _bucket_start(bucket + 1, bucket_seconds)).alias("hi"),
    )


def flag_covered(
    rows: DataFrame,
    windows: DataFrame,
    *,
    key: str,
    at: str,
    start: str,
    end: str,
    name: str,
    horizon: DataFrame | None = None,
    bucket_seconds: int = HOUR,
) -> DataFrame:
    """Add `name`: is any window of the row's key open at the row's time, both ends included.

    Windows are united per key before they are cut into buckets, so overlapping ones cost their common
    time once and a bucket lists only pieces that don't touch. Each row looks up one (key, bucket), so
    rows are never multiplied. A window without an end covers nothing. `horizon` is a one-row (lo, hi)
    frame that spans the rows' times; it bounds how far a window with a far-off end is cut into buckets.
    """
    if horizon is None:
        horizon = rows.agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    coverage = (
        _clipped_pieces(merged_windows(windows, key, start, end), horizon, bucket_seconds)
        .groupBy("_key", "_bucket")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("_open"))
    )
    joined = rows.join(
        coverage,
        (F.col(key) == F.col("_key"))
        & (time_bucket(F.col(at), bucket_seconds) == F.col("_bucket")),
        "left",
    )
    inside = F.exists("_open", lambda w: F.col(at).between(w["lo"], w["hi"]))
    return joined.select(*rows.columns, F.coalesce(inside, F.lit(False)).alias(name))

