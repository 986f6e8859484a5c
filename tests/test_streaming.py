import datetime as dt

from conftest import alerts_df, at, rows, trips_df, updates_df

from headway import schemas
from headway.plans import silver, staging, star
from headway.sinks import tables
from headway.sinks.upsert import UpsertTable
from headway.sources import realtime
from headway.streaming import ingest


def land(spark, landing, *items):
    tables.append_snapshot(updates_df(spark, *items).drop("dt"), landing, schemas.TRIP_UPDATES)


def test_files_are_ingested_exactly_once(spark, tmp_path):
    landing, bronze, log = (str(tmp_path / n) for n in ("landing", "bronze", "log"))

    def load():
        ingest.ingest_files(
            spark, landing, bronze, log, schemas.TRIP_UPDATES, max_files=1
        ).awaitTermination()

    land(spark, landing, {"entity_id": "a"}, {"entity_id": "b"})
    land(spark, landing, {"entity_id": "c", "_ingested_at": at("2026-09-17T00:00:00")})
    load()
    load()
    late = {"entity_id": "d", "_ingested_at": at("2026-09-10T00:00:00")}
    land(spark, landing, late)
    load()
    got = realtime.read_snapshots(spark, bronze, schemas.TRIP_UPDATES).select("entity_id", "dt")
    assert rows(got) == [
        ("a", dt.date(2026, 9, 16)),
        ("b", dt.date(2026, 9, 16)),
        ("c", dt.date(2026, 9, 17)),
        ("d", dt.date(2026, 9, 10)),
    ]


def test_streamed_upsert_equals_one_batch(spark, tmp_path):
    landing, log = str(tmp_path / "landing"), str(tmp_path / "log")
    table = UpsertTable(spark, str(tmp_path / "fact"))
    trips = trips_df(spark, "t1")

    def to_rows(batch):
        return star.fact_trip_stop(silver.match_trips(silver.latest_snapshot(batch), trips))

    items = [
        {"stop_id": s, "arrival_delay_seconds": float(n), "_ingested_at": at(f"2026-09-16T{9 - n:02}:00:00")}
        for n, s in enumerate("aabbc")
    ]
    for some in (items[:2], items[2:]):
        land(spark, landing, *some)
        ingest.upsert_files(
            spark, landing, table, log, schemas.TRIP_UPDATES, to_rows, max_files=1
        ).awaitTermination()
    assert rows(table.read()) == rows(to_rows(staging.trip_updates(updates_df(spark, *items))))


def test_repeated_captures_pass_once_and_the_fact_stays_distinct(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    captures = alerts_df(
        spark,
        *[{"_ingested_at": at(f"2026-09-16T08:{m:02}:00")} for m in (0, 15, 30)],
        {"entity_id": "a2"},
    )
    tables.append_snapshot(captures.drop("dt"), landing, schemas.SERVICE_ALERTS)
    stream = spark.readStream.schema(schemas.SERVICE_ALERTS).parquet(landing)
    (
        ingest.first_captures(stream, ["entity_id", "route_id"])
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "log"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    kept = spark.read.parquet(out)
    assert rows(kept.select("entity_id")) == [("a1",), ("a2",)]
    again = kept.unionByName(captures)
    assert star.fact_service_alerts(staging.service_alerts(again)).count() == 2
