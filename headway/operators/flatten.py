"""Nested feed messages to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import constants as C
from headway import schemas
from headway.functions.columns import enum_name, epoch_timestamp


def _text(field: Column) -> Column:
    return F.coalesce(field, F.lit(""))


def _when_present(message: Column, field: str) -> Column:
    """A number of an optional sub-message: null without the sub-message, zero if it is there but
    leaves the number unset."""
    return F.when(message.isNotNull(), F.coalesce(message[field], F.lit(0)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared columns and types, so that every snapshot is written alike."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _without_partition(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != "dt"])


def flatten_trip_updates(messages: DataFrame) -> DataFrame:
    """One row per stop-time update; entities of other kinds give none."""
    entities = (
        messages.select(
            epoch_timestamp(F.col("header.timestamp")).alias("feed_timestamp"),
            "_ingested_at",
            F.explode("entity").alias("entity"),
        )
        .filter(F.col("entity.trip_update").isNotNull())
        .select(
            "feed_timestamp",
            "_ingested_at",
            _text(F.col("entity.id")).alias("entity_id"),
            F.col("entity.trip_update.trip").alias("trip"),
            F.explode("entity.trip_update.stop_time_update").alias("stu"),
        )
    )
    trip, stu = F.col("trip"), F.col("stu")
    rows = entities.select(
        "entity_id",
        _text(trip["trip_id"]).alias("trip_id"),
        _text(trip["route_id"]).alias("route_id"),
        _text(trip["start_date"]).alias("start_date"),
        enum_name(trip["schedule_relationship"], C.TRIP_RELATIONSHIP).alias(
            "schedule_relationship"
        ),
        _text(stu["stop_id"]).alias("stop_id"),
        F.coalesce(stu["stop_sequence"], F.lit(0)).alias("stop_sequence"),
        _when_present(stu["arrival"], "delay").alias("arrival_delay_seconds"),
        _when_present(stu["arrival"], "time").alias("arrival_time"),
        _when_present(stu["departure"], "delay").alias("departure_delay_seconds"),
        _when_present(stu["departure"], "time").alias("departure_time"),
        enum_name(stu["schedule_relationship"], C.STOP_RELATIONSHIP).alias(
            "stop_schedule_relationship"
        ),
        "feed_timestamp",
        "_ingested_at",
    )
    return conform(rows, _without_partition(schemas.TRIP_UPDATES))


def flatten_alerts(messages: DataFrame) -> DataFrame:
    """One row per informed entity; an alert that names none still gives one row.

    Only the first active period and the first translation are used.
    """
    alerts = (
        messages.select("_ingested_at", F.explode("entity").alias("entity"))
        .filter(F.col("entity.alert").isNotNull())
        .select(
            "_ingested_at",
            _text(F.col("entity.id")).alias("entity_id"),
            F.col("entity.alert").alias("alert"),
            F.explode_outer("entity.alert.informed_entity").alias("informed"),
        )
    )
    alert, informed = F.col("alert"), F.col("informed")
    period = F.get(alert["active_period"], F.lit(0))

    def first_text(field: str) -> Column:
        translation = F.get(alert[field]["translation"], F.lit(0))
        return F.when(translation.isNotNull(), _text(translation["text"]))

    def named(value: Column, present: Column) -> Column:
        return F.when(present.isNotNull(), _text(value))

    rows = alerts.select(
        "entity_id",
        enum_name(alert["cause"], C.ALERT_CAUSE).alias("cause"),
        enum_name(alert["effect"], C.ALERT_EFFECT).alias("effect"),
        first_text("header_text").alias("header_text"),
        first_text("description_text").alias("description_text"),
        named(informed["route_id"], informed).alias("route_id"),
        named(informed["stop_id"], informed).alias("stop_id"),
        named(informed["trip"]["trip_id"], informed["trip"]).alias("trip_id"),
        epoch_timestamp(period["start"]).alias("active_period_start"),
        epoch_timestamp(period["end"]).alias("active_period_end"),
        "_ingested_at",
    )
    return conform(rows, _without_partition(schemas.SERVICE_ALERTS))
