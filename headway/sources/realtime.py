"""Realtime snapshot folders: <root>/dt=YYYY-MM-DD/*.parquet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.sinks.ledger import ensure_exists, read_or_empty
from headway.sources.manifest import list_files, partition_day


def read_snapshots(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All snapshots in declared types; `dt` is the folder name as a date, so filters on it prune folders."""
    return read_or_empty(spark, root, schema).select(*schema.names)


def append_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    *,
    since: dt.date | None = None,
) -> list[str]:
    """Batch load: append the files whose path the target has not recorded; returns their paths.

    Keyed on the file, so two files of one instant both load and a file is taken whole or not at all.
    `since` limits both sides to recent day folders.
    """
    tracked = T.StructType([*schema.fields, T.StructField("_source_file", T.StringType())])
    ensure_exists(spark, target, tracked, ["dt"])
    landed = list_files(spark, source).filter(F.col("path").endswith(".parquet"))
    done = spark.read.schema(tracked).parquet(target)
    if since is not None:
        landed = landed.filter(partition_day(F.col("path")) >= F.lit(since))
        done = done.filter(F.col("dt") >= F.lit(since))
    recorded = done.select(F.col("_source_file").alias("path")).distinct()
    new = [r["path"] for r in landed.join(recorded, "path", "left_anti").select("path").collect()]
    if new:
        rows = spark.read.schema(schema).option("basePath", source).parquet(*new)
        (
            rows.select(*schema.names, F.col("_metadata.file_path").alias("_source_file"))
            .write.mode("append")
            .option("mergeSchema", True)
            .partitionBy("dt")
            .parquet(target)
        )
    return new
