from conftest import at, one, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas
from headway.operators.flatten import conform, flatten_alerts, flatten_trip_updates

INGESTED = at("2024-09-10T20:30:00")


def trip_feed(spark, *entities, timestamp=1726000000):
    message = (("2.0", timestamp), list(entities), INGESTED)
    return spark.createDataFrame([message], schemas.TRIP_UPDATE_MESSAGE)


def trip_entity(**changes):
    trip = ("T123.456", "T1", "20260916", None)
    stop = ("2000123", 5, None, (180, 1726000100), (200, 1726000140))
    return (
        changes.get("id", "1"),
        (changes.get("trip", trip), changes.get("stops", [stop])),
    )


def test_one_row_per_stop_update(spark):
    got = one(flatten_trip_updates(trip_feed(spark, trip_entity())))
    assert got.asDict() == {
        "entity_id": "1",
        "trip_id": "T123.456",
        "route_id": "T1",
        "start_date": "20260916",
        "schedule_relationship": "SCHEDULED",
        "stop_id": "2000123",
        "stop_sequence": 5,
        "arrival_delay_seconds": 180.0,
        "arrival_time": 1726000100.0,
        "departure_delay_seconds": 200.0,
        "departure_time": 1726000140.0,
        "stop_schedule_relationship": "SCHEDULED",
        "feed_timestamp": got.feed_timestamp,
        "_ingested_at": got["_ingested_at"],
    }
    seconds = flatten_trip_updates(trip_feed(spark, trip_entity())).select(
        F.unix_seconds("feed_timestamp")
    )
    assert one(seconds)[0] == 1726000000


def test_several_stops_share_the_trip(spark):
    stops = [(f"s{i}", i, None, None, None) for i in range(3)]
    got = flatten_trip_updates(trip_feed(spark, trip_entity(stops=stops)))
    assert rows(got.select("trip_id", "stop_id")) == [("T123.456", f"s{i}") for i in range(3)]


def test_entities_of_other_kinds_give_nothing(spark):
    assert flatten_trip_updates(trip_feed(spark, ("no-trip-update", None))).isEmpty()


def test_empty_feed(spark):
    assert flatten_trip_updates(trip_feed(spark)).isEmpty()


def test_missing_header_time(spark):
    got = one(flatten_trip_updates(trip_feed(spark, trip_entity(), timestamp=0)))
    assert got.feed_timestamp is None


def test_delay_is_null_without_the_stop_event_and_zero_if_unset(spark):
    stops = [("a", 1, None, None, (None, None)), ("b", 2, 1, (5, None), None)]
    got = flatten_trip_updates(trip_feed(spark, trip_entity(stops=stops))).select(
        "stop_id",
        "arrival_delay_seconds",
        "arrival_time",
        "departure_delay_seconds",
        "departure_time",
        "stop_schedule_relationship",
    )
    assert rows(got) == [
        ("a", None, None, 0.0, 0.0, "SCHEDULED"),
        ("b", 5.0, 0.0, None, None, "SKIPPED"),
    ]


def test_unset_text_is_empty_and_unset_sequence_is_zero(spark):
    entity = trip_entity(trip=(None, None, None, 3), stops=[(None, None, None, None, None)])
    got = one(flatten_trip_updates(trip_feed(spark, entity)))
    assert (got.trip_id, got.route_id, got.start_date, got.stop_id) == ("", "", "", "")
    assert (got.stop_sequence, got.schedule_relationship) == (0, "CANCELED")


def test_types_do_not_depend_on_the_poll(spark):
    """Whole or missing numbers and all-null text columns keep their declared types."""
    got = flatten_trip_updates(trip_feed(spark, trip_entity()))
    expected = [f for f in schemas.TRIP_UPDATES.fields if f.name != "dt"]
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in expected]
    loose = spark.createDataFrame([(1, None)], "n int, t void")
    pinned = T.StructType([T.StructField("n", T.DoubleType()), T.StructField("t", T.StringType())])
    assert [f.dataType for f in conform(loose, pinned).schema] == [T.DoubleType(), T.StringType()]


def alert_feed(spark, *entities):
    return spark.createDataFrame([(("2.0", 1), list(entities), INGESTED)], schemas.ALERT_MESSAGE)


def text(value):
    return ([(value, "en"), ("other", "fr")],)


def alert(cause=9, effect=6, header=text("Trackwork"), description=text("Buses"), periods=None, informed=None):
    periods = [(1726000000, 1726010000), (1, 2)] if periods is None else periods
    return (cause, effect, header, description, periods, informed or [])


def test_alert_gives_one_row_per_informed_entity(spark):
    informed = [("T1", None, None), ("T2", "stop", ("trip",))]
    got = flatten_alerts(alert_feed(spark, ("a", alert(informed=informed))))
    columns = got.select(
        "entity_id", "cause", "effect", "header_text", "description_text", "route_id", "stop_id",
        "trip_id", F.unix_seconds("active_period_start"), F.unix_seconds("active_period_end"),
    )
    shared = ("a", "MAINTENANCE", "MODIFIED_SERVICE", "Trackwork", "Buses")
    assert rows(columns) == [
        (*shared, "T1", "", None, 1726000000, 1726010000),
        (*shared, "T2", "stop", "trip", 1726000000, 1726010000),
    ]


def test_entity_without_alert(spark):
    assert flatten_alerts(alert_feed(spark, ("x", None))).isEmpty()


def test_open_ended_alert_without_cause(spark):
    bare = alert(cause=None, effect=None, periods=[], informed=[("T1", None, None)])
    got = one(flatten_alerts(alert_feed(spark, ("a", bare))))
    assert (got.cause, got.effect) == ("UNKNOWN_CAUSE", "UNKNOWN_EFFECT")
    assert (got.active_period_start, got.active_period_end) == (None, None)


def test_alert_that_names_nothing_is_kept(spark):
    got = one(flatten_alerts(alert_feed(spark, ("a", alert(header=None, description=([],))))))
    assert (got.route_id, got.stop_id, got.trip_id) == (None, None, None)
    assert (got.header_text, got.description_text) == (None, None)


def test_zero_period_ends_are_missing(spark):
    got = one(flatten_alerts(alert_feed(spark, ("a", alert(periods=[(5, 0)])))))
    assert got.active_period_start is not None and got.active_period_end is None
