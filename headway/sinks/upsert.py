"""Keyed upsert into partitioned Parquet.

A batch is merged only with the partitions it touches. The merged partitions are first written to a
staging folder and then copied over the target's partitions, so no path is read and overwritten at
once. A run that dies while copying is finished from the staging folder by the next one.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import constants as C
from headway import schemas
from headway.operators.latest import latest_per_key
from headway.sinks.ledger import Ledger, ensure_exists, read_or_empty

LATEST_WINS = "latest_wins"
HIGH_WATER_MARK = "high_water_mark"


@dataclass(frozen=True)
class UpsertTable:
    """A Parquet table with one row per key, partitioned by one of the key columns. One writer at a time."""

    spark: SparkSession
    path: str
    schema: T.StructType = field(default_factory=lambda: schemas.FACT_TRIP_STOP)
    keys: Sequence[str] = tuple(C.FACT_GRAIN)
    partition: str = "service_date"
    version: str = "_ingested_at"

    @cached_property
    def _ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.path}_log")

    @property
    def _incoming(self) -> str:
        return f"{self.path}_incoming"

    @property
    def _staging(self) -> str:
        return f"{self.path}_staging"

    def read(self) -> DataFrame:
        # The declared schema keeps digit-only partition values text.
        return read_or_empty(self.spark, self.path, self.schema).select(*self.schema.names)

    def upsert(
        self, batch: DataFrame, *, mode: str = LATEST_WINS, batch_id: str | None = None
    ) -> None:
        """Merge `batch`. Per key the row with the newest version stays; the batch wins ties.

        LATEST_WINS gives the same table in whatever order batches arrive, and again if one is repeated.
        HIGH_WATER_MARK first drops batch rows not newer than the newest row of the table, so late
        rows never enter; an empty table takes everything.
        """
        ensure_exists(self.spark, self.path, self.schema, [self.partition])
        self.recover()
        # A batch delivered again is another attempt with its own entries.
        attempt = f"{batch_id or 'batch'}:{uuid.uuid4().hex}"
        if mode == HIGH_WATER_MARK:
            newest = self.read().agg(F.max(self.version)).scalar()
            batch = batch.filter(newest.isNull() | (F.col(self.version) > newest))
        elif mode != LATEST_WINS:
            raise ValueError(f"unknown mode {mode!r}")

        # Written once: what follows reads the batch more than once.
        batch.select(*self.schema.names).write.mode("overwrite").parquet(self._incoming)
        incoming = self._load(self._incoming)
        touched = self._touched(incoming)
        sided = incoming.withColumn("_side", F.lit(1)).unionByName(
            touched.withColumn("_side", F.lit(0))
        )
        merged = self._newest(sided, F.col("_side").desc()).drop("_side")
        # Few files per partition value; a value with most of the rows is split over several tasks.
        self._write(merged.hint("rebalance", self.partition), self._staging)
        self._ledger.record("upsert", [attempt], "staged")
        self._apply(attempt)

    def recover(self) -> None:
        """Finish a batch that was staged but not applied."""
        # The staging folder holds one batch, so there is at most one.
        for row in self._ledger.unfinished("upsert", "staged", "applied").limit(1).collect():
            self._apply(row["item"])

    def _apply(self, attempt: str) -> None:
        # Staged files hold one partition value each, so they are copied without another shuffle.
        self._write(self._load(self._staging), self.path, dynamic=True)
        self._ledger.record("upsert", [attempt], "applied")

    def _load(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(path).select(*self.schema.names)

    def _newest(self, df: DataFrame, *tie_break: Column) -> DataFrame:
        ties = [F.col(c).desc() for c in self.schema.names if c not in self.keys]
        order = [F.col(self.version).desc(), *tie_break, *ties]
        return latest_per_key(df, self.keys, order)

    def _write(self, df: DataFrame, path: str, dynamic: bool = False) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
            .partitionBy(self.partition)
            .parquet(path)
        )

    def _touched(self, incoming: DataFrame) -> DataFrame:
        """Existing rows of the partitions the batch has rows in."""
        return self.partitions_of(incoming.select(self.partition).distinct())

    def partitions_of(self, values: DataFrame) -> DataFrame:
        """The table's rows in the partitions listed by the one-column frame `values`.

        Partitions are found by a join on the partition column, which prunes the scan at run time, whatever the number
        of values. The partition without a value, which such a join doesn't find, is read if it is listed.
        """
        existing, column, value = self.read(), F.col(self.partition), F.col("_value")
        wanted = values.select(F.col(self.partition).alias("_value"))
        # the condition on the value tells the optimizer that the join is worth pruning by
        found = existing.join(wanted.filter(value >= F.lit("")), column == value, "left_semi")
        if wanted.filter(value.isNull()).isEmpty():
            return found
        return found.unionByName(existing.filter(column.isNull()))

    def changed_since(self, moment: dt.datetime | None) -> DataFrame:
        """The partition values with a file written after `moment`, or all. Looks at files, not at rows."""
        files = self.spark.read.schema(self.schema).parquet(self.path)
        if moment is not None:
            files = files.filter(F.col("_metadata.file_modification_time") > F.lit(moment))
        return files.select(self.partition).distinct()


def refreshed_orphans(fact: DataFrame, new_trips: DataFrame) -> DataFrame:
    """Fact rows flagged as orphans whose trip a later timetable has brought, with the flag cleared.

    Upserting them corrects the table: their version is unchanged and a batch wins ties.
    """
    orphans = fact.filter("is_orphan_trip")
    return orphans.join(new_trips.select("trip_id"), "trip_id", "left_semi").select(
        *[F.lit(False).alias(c) if c == "is_orphan_trip" else F.col(c) for c in fact.columns]
    )
