"""Staging: the columns the products use, one row per timetable key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import schemas
from headway.operators.latest import latest_per_key


def trip_updates(bronze: DataFrame) -> DataFrame:
    return bronze.select(*[f.name for f in schemas.TRIP_UPDATES.fields if f.name != "dt"])


def service_alerts(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("entity_id").alias("alert_id"),
        *[f.name for f in schemas.SERVICE_ALERTS.fields if f.name not in ("entity_id", "dt")],
    )


def static_table(table: str, bronze: DataFrame) -> DataFrame:
    """The newest row of each key over all loaded timetable versions."""
    columns = [*schemas.STATIC[table].fieldNames(), "_feed_version", "_ingested_at"]
    order = [F.col("_ingested_at").desc(), F.col("_feed_version").desc()]
    # A version may repeat a key; the remaining columns make the choice repeatable.
    keys = schemas.STATIC_KEYS[table]
    ties = [F.col(c) for c in schemas.STATIC[table].fieldNames() if c not in keys]
    return latest_per_key(bronze.select(*columns), keys, [*order, *ties])
