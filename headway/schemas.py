"""Declared schemas. Nothing in this package infers a type from data."""

from pyspark.sql import types as T

_S, _L, _D, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


# Realtime tables; `dt` is the landing-directory partition.
TRIP_UPDATES = _struct(
    entity_id=_S,
    trip_id=_S,
    route_id=_S,
    start_date=_S,
    schedule_relationship=_S,
    stop_id=_S,
    stop_sequence=_L,
    arrival_delay_seconds=_D,
    arrival_time=_D,
    departure_delay_seconds=_D,
    departure_time=_D,
    stop_schedule_relationship=_S,
    feed_timestamp=_TS,
    _ingested_at=_TS,
    dt=T.DateType(),
)

SERVICE_ALERTS = _struct(
    entity_id=_S,
    cause=_S,
    effect=_S,
    header_text=_S,
    description_text=_S,
    route_id=_S,
    stop_id=_S,
    trip_id=_S,
    active_period_start=_TS,
    active_period_end=_TS,
    _ingested_at=_TS,
    dt=T.DateType(),
)

# Static timetable files. Times of day stay text: they run past 24:00:00.
_WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

STATIC = {
    "routes": _struct(
        route_id=_S,
        route_short_name=_S,
        route_long_name=_S,
        route_type=T.IntegerType(),
        agency_id=_S,
    ),
    "stops": _struct(stop_id=_S, stop_name=_S, stop_lat=_D, stop_lon=_D, parent_station=_S),
    "trips": _struct(trip_id=_S, route_id=_S, service_id=_S, trip_headsign=_S),
    "stop_times": _struct(
        trip_id=_S, stop_id=_S, stop_sequence=_L, arrival_time=_S, departure_time=_S
    ),
    "calendar": _struct(
        service_id=_S, **{day: T.IntegerType() for day in _WEEKDAYS}, start_date=_S, end_date=_S
    ),
}

STATIC_LINEAGE = _struct(_feed_version=_S, _source_file=_S, _ingested_at=_TS)

# One row per timetable key.
STATIC_KEYS = {
    "routes": ["route_id"],
    "stops": ["stop_id"],
    "trips": ["trip_id"],
    "stop_times": ["trip_id", "stop_sequence"],
    "calendar": ["service_id"],
}


def static_schema(table: str) -> T.StructType:
    """A timetable table as stored: its own columns plus lineage."""
    return T.StructType(STATIC[table].fields + STATIC_LINEAGE.fields)


# Nested feed messages, as they arrive before flattening.
_HEADER = _struct(gtfs_realtime_version=_S, timestamp=_L)
_STOP_EVENT = _struct(delay=T.IntegerType(), time=_L)
_TRIP = _struct(trip_id=_S, route_id=_S, start_date=_S, schedule_relationship=T.IntegerType())
_STOP_TIME_UPDATE = _struct(
    stop_id=_S,
    stop_sequence=_L,
    schedule_relationship=T.IntegerType(),
    arrival=_STOP_EVENT,
    departure=_STOP_EVENT,
)

TRIP_UPDATE_MESSAGE = _struct(
    header=_HEADER,
    entity=T.ArrayType(
        _struct(
            id=_S,
            trip_update=_struct(trip=_TRIP, stop_time_update=T.ArrayType(_STOP_TIME_UPDATE)),
        )
    ),
    _ingested_at=_TS,
)

_TEXT = _struct(translation=T.ArrayType(_struct(text=_S, language=_S)))

ALERT_MESSAGE = _struct(
    header=_HEADER,
    entity=T.ArrayType(
        _struct(
            id=_S,
            alert=_struct(
                cause=T.IntegerType(),
                effect=T.IntegerType(),
                header_text=_TEXT,
                description_text=_TEXT,
                active_period=T.ArrayType(_struct(start=_L, end=_L)),
                informed_entity=T.ArrayType(
                    _struct(route_id=_S, stop_id=_S, trip=_struct(trip_id=_S))
                ),
            ),
        )
    ),
    _ingested_at=_TS,
)

FACT_TRIP_STOP = _struct(
    date_key=T.IntegerType(),
    service_date=_S,
    route_key=_L,
    stop_key=_L,
    stop_id=_S,
    trip_id=_S,
    stop_sequence=_L,
    schedule_relationship=_S,
    arrival_delay_seconds=_D,
    departure_delay_seconds=_D,
    is_late=T.BooleanType(),
    is_cancelled=T.BooleanType(),
    is_orphan_trip=T.BooleanType(),
    is_delay_outlier=T.BooleanType(),
    feed_timestamp=_TS,
    _ingested_at=_TS,
)
