"""Collects the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapt import Transit

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Transit], DataFrame]) -> Callable[[Transit], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(Transit(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps without a zone and dates as text, which both engines hand over alike."""
    plain = {"timestamp": "timestamp_ntz", "date": "string"}
    return df.select(
        *[F.col(n).cast(plain[t]).alias(n) if t in plain else F.col(n) for n, t in df.dtypes]
    )


def all_queries() -> dict[str, Query]:
    """Every query, after importing the modules that register them."""
    import checks.io_queries  # noqa: F401
    import checks.queries  # noqa: F401

    return dict(QUERIES)
