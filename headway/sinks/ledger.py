"""An append-only record of finished steps, so that a restarted job knows what is already done."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """The data at `path`, or no rows if nothing has been written there yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ensure_exists(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Create an empty table at `path` unless something is there."""
    empty = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    empty.write.mode("ignore").partitionBy(*partition_by).format(fmt).save(path)


class Ledger:
    """Rows (scope, item, state, recorded_at) under one path. One writer at a time."""

    SCHEMA = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("scope", "item", "state")]
        + [T.StructField("recorded_at", T.TimestampType())]
    )

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        ensure_exists(spark, path, self.SCHEMA, fmt="json")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).json(self.path)

    def items(self, scope: str, state: str) -> DataFrame:
        return (
            self.rows()
            .filter((F.col("scope") == scope) & (F.col("state") == state))
            .select("item")
            .distinct()
        )

    def unfinished(self, scope: str, begun: str, done: str) -> DataFrame:
        """Items that reached `begun` and never `done`."""
        state = F.col("state")
        seen = self.rows().filter(F.col("scope") == scope).groupBy("item")
        return (
            seen.agg(F.bool_or(state == begun).alias("begun"), F.bool_or(state == done).alias("done"))
            .filter("begun AND NOT done")
            .select("item")
        )

    def record(self, scope: str, items: Iterable[str], state: str) -> None:
        names = list(items)
        if names:
            (
                self.spark.range(0, 1, 1, 1)
                .select(
                    F.lit(scope).alias("scope"),
                    F.explode(F.array(*[F.lit(n) for n in names])).alias("item"),
                    F.lit(state).alias("state"),
                    F.current_timestamp().alias("recorded_at"),
                )
                .write.mode("append")
                .json(self.path)
            )
