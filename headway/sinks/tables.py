"""Full-refresh tables, snapshots and extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.operators.flatten import conform


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replace the table at `path`; the row count is observed during the write."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        # Even files per partition value; a value with most of the rows is split over several tasks.
        counted = counted.hint("rebalance", *partition_by)
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def replace_partitions(df: DataFrame, path: str, *partition: str) -> None:
    """Replace the partitions `df` has rows in and leave the others."""
    (
        df.hint("rebalance", *partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )


def append_snapshot(rows: DataFrame, path: str, schema: T.StructType) -> int:
    """Append flattened feed rows under dt=<ingest day>, in the declared column types."""
    dated = conform(rows.withColumn("dt", F.to_date("_ingested_at")), schema)
    seen = Observation()
    (
        dated.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .partitionBy("dt")
        .parquet(path)
    )
    return seen.get["rows"]


def export_csv(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """One CSV folder per table, header in every file, quotes doubled inside quoted text."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        (
            df.write.mode("overwrite")
            .option("header", True)
            .option("escape", '"')
            .csv(paths[name])
        )
    return paths
