"""Incremental loads driven by new files. Each call works off what is new and stops."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from headway.sinks.ledger import read_or_empty
from headway.sinks.tables import replace_partitions
from headway.sinks.upsert import LATEST_WINS, UpsertTable
from headway.sources.footers import FILES, landed_types, read_as

#: Files of a micro-batch at most; their paths pass through the driver.
MAX_FILES = 5000
#: How a failed write shows; inside a stream it comes as the JVM raised it.
FAILURES = (PySparkException, Py4JJavaError)
LOADS = "files long, rows long, load string"
QUARANTINE = "path string, problem string, load string"


def _snapshots(
    spark: SparkSession, source: str, schema: T.StructType, max_files: int | None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(source)


def ingest_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    *,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append every landed Parquet file to the bronze table exactly once, whatever types its columns have.

    The stream is one of files, of which the checkpoint remembers those read. A micro-batch (MAX_FILES files unless given)
    writes folders of its own, named by its files, so one that is delivered again replaces what it wrote. Files that
    can't be read are listed in the quarantine of the table, and the load goes on. Files without a byte are never listed.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files or MAX_FILES)
        .load(source)
    )
    return (
        files.writeStream.foreachBatch(lambda batch, _: load_files(batch, source, target, schema))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def quarantine_of(target: str) -> str:
    return f"{target.rstrip('/')}_quarantine"


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """(path, problem, load) of the files that the table could not take."""
    return read_or_empty(spark, quarantine_of(target), QUARANTINE)


def _loads_of(target: str) -> str:
    return f"{target.rstrip('/')}_loads"


def read_loads(spark: SparkSession, target: str) -> DataFrame:
    """(files, rows, load) of every batch that the table took, counted while it was written."""
    return read_or_empty(spark, _loads_of(target), LOADS)


def load_files(files: DataFrame, source: str, target: str, schema: T.StructType) -> None:
    """Write one batch of (path, content) into `target`: files are grouped by the types in their footers, each group is read
    as what it is, and all are cast to the declared types.

    The driver holds the paths of one batch, no rows. A file whose footer is fine but whose pages are not is found by
    halving, and only when the batch has failed.
    """
    spark = files.sparkSession
    told = landed_types(files, schema).collect()
    if not told:
        return
    load = "b" + hashlib.sha256("\n".join(sorted(r.path for r in told)).encode()).hexdigest()[:16]
    bad = [(r.path, r.problem) for r in told if r.problem]
    groups: dict[str, list[str]] = {}
    for row in told:
        if not row.problem:
            groups.setdefault(row.types, []).append(row.path)

    def rows(some: dict[str, list[str]]) -> DataFrame:
        return reduce(DataFrame.unionByName, [read_as(spark, source, paths, types, schema) for types, paths in some.items()])

    def unreadable(types: str, paths: list[str]) -> list[tuple[str, str]]:
        try:
            rows({types: paths}).write.format("noop").mode("overwrite").save()
        except FAILURES as error:
            if not _of_a_file(error):
                raise
            if len(paths) == 1:
                return [(paths[0], _of_a_file(error))]
            half = len(paths) // 2
            return unreadable(types, paths[:half]) + unreadable(types, paths[half:])
        return []

    def write() -> None:
        if groups:
            seen = Observation()
            counted = rows(groups).observe(seen, F.count(F.lit(1)).alias("rows"))
            replace_partitions(counted.withColumn("load", F.lit(load)), target, "load", "dt")
            count = (sum(map(len, groups.values())), seen.get["rows"], load)
            replace_partitions(spark.createDataFrame([count], LOADS), _loads_of(target), "load")

    with nanoseconds_as_numbers(spark):
        try:
            write()
        except FAILURES as error:
            if not _of_a_file(error):
                raise
            found = [x for types, paths in groups.items() for x in unreadable(types, paths)]
            if not found:
                raise
            bad += found
            lost = {path for path, _ in found}
            groups = {t: good for t, paths in groups.items() if (good := [p for p in paths if p not in lost])}
            write()
    if bad:
        listed = spark.createDataFrame([(*x, load) for x in bad], QUARANTINE)
        replace_partitions(listed, quarantine_of(target), "load")


def _of_a_file(error: Exception) -> str:
    """What is wrong with a file, if that is what the error says."""
    found = re.search(r"\[((?:FAILED_READ_FILE|PARQUET_|CANNOT_READ_FILE)[^\n]*)", str(error))
    return found[1] if found else ""


@contextmanager
def nanoseconds_as_numbers(spark: SparkSession) -> Iterator[None]:
    """Spark reads Parquet times in nanoseconds as numbers or not at all."""
    name = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def upsert_files(
    spark: SparkSession,
    source: str,
    table: UpsertTable,
    checkpoint: str,
    schema: T.StructType,
    to_rows: Callable[[DataFrame], DataFrame],
    *,
    mode: str = LATEST_WINS,
    max_files: int | None = None,
) -> StreamingQuery:
    """Upsert every landed file into a keyed table through `to_rows`.

    A micro-batch may be delivered again after a failure; the upsert gives the same table then.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.upsert(to_rows(batch), mode=mode, batch_id=f"{checkpoint}#{batch_id}")

    return (
        _snapshots(spark, source, schema, max_files)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_captures(alerts: DataFrame, keys: list[str], *, keep: str = "1 day") -> DataFrame:
    """Drop repeated captures of an alert seen within `keep`, with state bounded by that time.

    A capture repeated later passes again, so the alert fact still takes distinct rows. As with any
    watermark, rows older than `keep` behind the newest one are not let through: `keep` must exceed
    how late a file can land. The batch form, fact_service_alerts, has no such limit.
    """
    return alerts.withWatermark("_ingested_at", keep).dropDuplicatesWithinWatermark(keys)
