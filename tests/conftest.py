import datetime as dt

import pytest
from pyspark.sql import SparkSession

from headway.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = build_session(
        "headway-tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    """A UTC instant, as the session reads naive datetimes in UTC through text."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(df):
    found = df.collect()
    assert len(found) == 1, found
    return found[0]


def update(**values) -> dict:
    """A flattened trip update with ordinary values for whatever is not given."""
    base = {
        "entity_id": "e",
        "trip_id": "t1",
        "route_id": "r1",
        "start_date": "",
        "schedule_relationship": "SCHEDULED",
        "stop_id": "s1",
        "stop_sequence": 1,
        "arrival_delay_seconds": 10.0,
        "arrival_time": None,
        "departure_delay_seconds": None,
        "departure_time": None,
        "stop_schedule_relationship": "SCHEDULED",
        "feed_timestamp": at("2026-09-16T08:00:00"),
        "_ingested_at": at("2026-09-16T08:00:05"),
        "dt": dt.date(2026, 9, 16),
    }
    return {**base, **values}


def updates_df(spark, *items: dict):
    from headway import schemas

    return spark.createDataFrame(
        [tuple(update(**i)[n] for n in schemas.TRIP_UPDATES.names) for i in items],
        schemas.TRIP_UPDATES,
    )


def alerts_df(spark, *items: dict):
    from headway import schemas

    base = {n: None for n in schemas.SERVICE_ALERTS.names}
    base |= {
        "entity_id": "a1",
        "cause": "MAINTENANCE",
        "effect": "DETOUR",
        "header_text": "Works",
        "route_id": "r1",
        "_ingested_at": at("2026-09-16T08:00:05"),
        "dt": dt.date(2026, 9, 16),
    }
    return spark.createDataFrame(
        [tuple({**base, **i}[n] for n in schemas.SERVICE_ALERTS.names) for i in items],
        schemas.SERVICE_ALERTS,
    )


def trips_df(spark, *trip_ids: str, version: str = "v1", ingested: str = "2026-09-01T00:00:00"):
    from headway import schemas

    return spark.createDataFrame(
        [(t, "r1", "wk", f"to {t}", version, "f", at(ingested)) for t in trip_ids],
        schemas.static_schema("trips"),
    )


def routes_df(spark, *items: tuple):
    """(route_id, short name, route_type)"""
    return spark.createDataFrame(
        [(r, n, f"{r} long", k, "op") for r, n, k in items],
        "route_id string, route_short_name string, route_long_name string, route_type int, "
        "agency_id string",
    )
