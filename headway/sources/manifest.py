"""File listings as DataFrames, and what one location has that another lacks."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import constants as C

# Fixed values: <feed>/<agency>/dt=YYYY-MM-DD/<file>, and the version at the end of a file's stem.
SUBPATH_PATTERN = r"([^/]+/[^/]+/dt=[^/]+/[^/]+)$"
DAY_PATTERN = r"dt=(\d{4}-\d{2}-\d{2})/"
VERSION_PATTERN = r"([^/_]*?)(?:\.[^./]*)?$"

VERSION_LENGTH = 12


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified) of every file below `root`; contents are not read. No rows if it is missing."""
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def subpath(path: Column) -> Column:
    return F.regexp_extract(path, SUBPATH_PATTERN, 1)


def partition_day(path: Column) -> Column:
    return F.try_to_timestamp(F.nullif(F.regexp_extract(path, DAY_PATTERN, 1), F.lit(""))).cast(
        "date"
    )


def missing_files(
    source: DataFrame, target: DataFrame, *, today: dt.date, days: int = C.SYNC_WINDOW_DAYS
) -> DataFrame:
    """Parquet files of the last `days` days that `source` lists and `target` does not, by subpath."""
    recent = source.select(subpath(F.col("path")).alias("subpath")).filter(
        F.col("subpath").endswith(".parquet")
        & (partition_day(F.col("subpath")) >= F.lit(today - dt.timedelta(days=days)))
    )
    present = target.select(subpath(F.col("path")).alias("subpath"))
    return recent.distinct().join(present, "subpath", "left_anti")


def version_from_name(path: Column) -> Column:
    """The text after the last underscore of the file's stem."""
    return F.regexp_extract(path, VERSION_PATTERN, 1)


def content_version(content: Column) -> Column:
    """A tag of the content, so that an unchanged file published again keeps its version."""
    return F.substring(F.sha2(content, 256), 1, VERSION_LENGTH)


def payload_versions(spark: SparkSession, root: str) -> DataFrame:
    """(path, version) of every payload below `root`, tagged by content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", content_version(F.col("content")).alias("version"))


def one_path_per_version(files: DataFrame) -> DataFrame:
    """The last path, in path order, of each version named by the files."""
    return files.groupBy(version_from_name(F.col("path")).alias("version")).agg(
        F.max("path").alias("path")
    )


def known_versions(*manifests: DataFrame) -> DataFrame:
    """The distinct versions of several manifests, in order."""
    union = manifests[0].select("version")
    for manifest in manifests[1:]:
        union = union.union(manifest.select("version"))
    return union.distinct().orderBy("version")
