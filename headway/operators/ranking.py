"""Ordered shares and top rows of an aggregated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import pct
from headway.operators.intervals import running_totals


#: Buckets that rows of value zero are dealt over.
ZERO_BUCKETS = 64


def magnitude_bucket(value: Column, deal: Column | None = None) -> Column:
    """Larger values get smaller buckets; about six percent of the value wide, so a few hundred cover any
    range of 64-bit totals. Zeros come
    last, dealt over ZERO_BUCKETS by the hash `deal`: among them the order changes no total."""
    width = F.floor(F.log2(F.abs(value).cast("double")) * 12)
    zeros = F.lit(1) if deal is None else 1 + F.pmod(deal, F.lit(ZERO_BUCKETS))
    return F.when(value > 0, -width).when(value < 0, 1 + ZERO_BUCKETS + width).otherwise(zeros).cast("bigint")


def cumulative_share(
    df: DataFrame, value: str, tie_break: Sequence[str], share: str, cumulative: str
) -> DataFrame:
    """Each row's percentage of the total of a non-negative whole-number column, and the running
    percentage from the largest value down. Both are null if the total is zero.

    Only one row per magnitude bucket passes through a single task.
    """
    ranked = df.select(
        "*",
        F.col(value).alias("_running"),
        magnitude_bucket(F.col(value), F.xxhash64(*tie_break)).alias("_magnitude"),
    )
    running = running_totals(
        ranked,
        [],
        "_magnitude",
        [F.col(value).desc(), *[F.col(c).asc() for c in tie_break]],
        ["_running"],
    )
    whole = F.nullif(F.col("_running_total"), F.lit(0))
    return running.select(
        *df.columns,
        pct(F.col(value), whole).alias(share),
        pct(F.col("_running"), whole).alias(cumulative),
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows; every task keeps at most n."""
    return df.orderBy(*order).limit(n)
