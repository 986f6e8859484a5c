"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under `order`, which must break every tie.

    The rank filter lets Spark cut each key to one row on the map side before the shuffle, so a key
    that holds a large share of the input sends at most one row per map task.

    A hash of the key leads the window's partitioning. Sorting compares the first eight bytes of the
    first column in place; a hash tells nearly all keys apart there, a date or a common text prefix few.
    It also leaves a following join on the same keys its own exchange, which adaptive execution
    can split when a key is hot; it cannot split a partitioning taken over from a window.
    """
    newest = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
