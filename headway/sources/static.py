"""Timetable files: scanned by name into declared types, each version loaded once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway import schemas
from headway.sinks.ledger import Ledger, read_or_empty
from headway.sources.manifest import list_files

FILE_SUFFIX = ".txt"


def read_static_file(
    spark: SparkSession, path: str, table: str, feed_version: str, source_file: str
) -> DataFrame:
    """One timetable file with lineage columns.

    Columns are matched by header name. Declared columns get their declared type, null where the text
    does not fit; columns not declared are kept as text.
    """
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    declared = schemas.STATIC[table]
    typed = [
        (F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None).cast("string"))
        .try_cast(f.dataType)
        .alias(f.name)
        for f in declared.fields
    ]
    extra = [F.col(f"`{c}`") for c in raw.columns if c not in declared.names]
    return raw.select(
        *typed,
        *extra,
        F.lit(feed_version).alias("_feed_version"),
        F.lit(source_file).alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )


def landed_versions(spark: SparkSession, landing: str) -> DataFrame:
    """(version, table) of every unpacked timetable file <landing>/<version>/<table>.txt."""
    parts = F.split(F.col("path"), "/")
    name = F.element_at(parts, -1)
    files = list_files(spark, landing).filter(name.endswith(FILE_SUFFIX))
    return files.select(
        F.element_at(parts, -2).alias("version"),
        F.regexp_replace(name, r"\.txt$", "").alias("table"),
    )


def _load_ledger(spark: SparkSession, bronze: str, table: str) -> Ledger:
    return Ledger(spark, f"{bronze.rstrip('/')}/gtfs_static_{table}_log")


def loaded_versions(spark: SparkSession, bronze: str, table: str) -> DataFrame:
    """The versions of a table whose load is complete, as `item`."""
    return _load_ledger(spark, bronze, table).items("load", "done")


def load_static_versions(
    spark: SparkSession, landing: str, bronze: str, table: str, available: DataFrame
) -> dict[str, int]:
    """Append the versions of one table that were never loaded; returns rows per newly loaded version.

    Earlier versions are never replaced: live data of a past day can only be matched with the
    timetable of its time. A version is written as one partition and recorded once complete, so a
    run that fails half-way writes the same partition again.
    """
    path = f"{bronze.rstrip('/')}/gtfs_static_{table}"
    ledger = _load_ledger(spark, bronze, table)
    loaded = ledger.items("load", "done").select(F.col("item").alias("version"))
    new = available.select("version").distinct().join(loaded, "version", "left_anti")
    versions = sorted(r["version"] for r in new.collect())
    if not versions:
        return {}
    frames = [
        read_static_file(
            spark, f"{landing.rstrip('/')}/{v}/{table}{FILE_SUFFIX}", table, v, f"extracted/{v}"
        )
        for v in versions
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    seen = Observation()
    counts = [F.count_if(F.col("_feed_version") == v).alias(v) for v in versions]
    (
        rows.observe(seen, *counts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_feed_version")
        .parquet(path)
    )
    ledger.record("load", versions, "done")
    return {v: seen.get[v] for v in versions}


def load_static(spark: SparkSession, landing: str, bronze: str) -> dict[str, dict[str, int]]:
    """Load every timetable table; it is an error if no version was ever landed."""
    landed = landed_versions(spark, landing)
    if landed.isEmpty():
        raise FileNotFoundError(f"no timetable version under {landing}")
    return {
        table: load_static_versions(
            spark, landing, bronze, table, landed.filter(F.col("table") == table)
        )
        for table in schemas.STATIC
    }


def read_static_table(spark: SparkSession, bronze: str, table: str) -> DataFrame:
    """The declared columns of every loaded version; the version is the partition column, kept as text."""
    schema = schemas.static_schema(table)
    rows = read_or_empty(spark, f"{bronze.rstrip('/')}/gtfs_static_{table}", schema)
    return rows.select(*schema.names)
