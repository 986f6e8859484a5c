import datetime as dt
import hashlib

import pytest
from conftest import alerts_df, at, one, rows, updates_df
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas
from headway.sinks import tables
from headway.sources import manifest, realtime, static


def write_version(landing, version, **files):
    folder = landing / version
    folder.mkdir(parents=True)
    for table, text in files.items():
        (folder / f"{table}.txt").write_text(text)


ROUTES_V1 = 'agency_id,route_id,route_short_name,route_long_name,route_type,colour\nop,r1,T1,"City, loop ""inner""",2,red\n'
ROUTES_V2 = "route_id,route_short_name,route_type\nr1,T1x,2\nr2,,soon\n"


def test_columns_are_matched_by_name_and_typed(spark, tmp_path):
    write_version(tmp_path, "v1", routes=ROUTES_V1)
    got = static.read_static_file(spark, str(tmp_path / "v1/routes.txt"), "routes", "v1", "a_v1.zip")
    row = one(got.drop("_ingested_at"))
    assert row.asDict() == {
        "route_id": "r1",
        "route_short_name": "T1",
        "route_long_name": 'City, loop "inner"',
        "route_type": 2,
        "agency_id": "op",
        "colour": "red",
        "_feed_version": "v1",
        "_source_file": "a_v1.zip",
    }


def test_times_of_day_stay_text(spark, tmp_path):
    text = "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n007,25:10:00,08:00:00,0012,3\n"
    write_version(tmp_path, "v1", stop_times=text)
    got = static.read_static_file(spark, str(tmp_path / "v1/stop_times.txt"), "stop_times", "v1", "f")
    assert rows(got.select("trip_id", "stop_id", "stop_sequence", "arrival_time")) == [
        ("007", "0012", 3, "25:10:00")
    ]


def test_versions_are_appended_once_and_never_replaced(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    write_version(landing, "20260901", routes=ROUTES_V1)
    assert static.load_static(spark, str(landing), bronze)["routes"] == {"20260901": 1}
    assert static.load_static(spark, str(landing), bronze)["routes"] == {}
    write_version(landing, "20260908", routes=ROUTES_V2, trips="trip_id,route_id\nt1,r1\n")
    loaded = static.load_static(spark, str(landing), bronze)
    assert loaded["routes"] == {"20260908": 2} and loaded["trips"] == {"20260908": 1}
    got = static.read_static_table(spark, bronze, "routes")
    assert rows(got.select("_feed_version", "route_id", "route_short_name", "route_type")) == [
        ("20260901", "r1", "T1", 2),
        ("20260908", "r1", "T1x", 2),
        ("20260908", "r2", None, None),
    ]
    # A table that was absent from the first version still loads the second.
    assert static.read_static_table(spark, bronze, "trips").count() == 1
    assert static.read_static_table(spark, bronze, "calendar").isEmpty()


def test_a_version_written_but_not_recorded_is_written_again(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    write_version(landing, "v1", routes=ROUTES_V1)
    half = static.read_static_file(spark, str(landing / "v1/routes.txt"), "routes", "v1", "x")
    half.write.partitionBy("_feed_version").parquet(f"{bronze}/gtfs_static_routes")
    static.load_static(spark, str(landing), bronze)
    assert static.read_static_table(spark, bronze, "routes").count() == 1


def test_no_version_anywhere_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        static.load_static(spark, str(tmp_path / "nothing"), str(tmp_path / "bronze"))


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def day_file(day, name="a.parquet"):
    return f"file:/x/gtfs_rt_trip_updates/agency/dt={day}/{name}"


def test_missing_files(spark):
    source = paths(
        spark,
        day_file("2026-11-20"),
        day_file("2026-11-20", "b.parquet"),
        day_file("2026-11-13"),
        day_file("2026-11-12"),
        day_file("2026-11-20", "notes.txt"),
        "file:/x/gtfs_rt_trip_updates/agency/loose.parquet",
    )
    target = paths(spark, day_file("2026-11-20").replace("/x/", "/volume/"))
    today = dt.date(2026, 11, 20)
    got = manifest.missing_files(source, target, today=today, days=7)
    prefix = "gtfs_rt_trip_updates/agency/dt=2026-11"
    assert rows(got) == [(f"{prefix}-13/a.parquet",), (f"{prefix}-20/b.parquet",)]
    everything = manifest.missing_files(source, target.limit(0), today=today, days=7)
    assert everything.count() == 3


def test_listing_a_missing_folder_is_empty(spark, tmp_path):
    assert manifest.list_files(spark, str(tmp_path / "none")).isEmpty()


@pytest.mark.parametrize(
    "path, version",
    [
        ("/a_b/20260916T0000_abc123.zip", "abc123"),
        ("plain.zip", "plain"),
        ("/x/one_two_three", "three"),
    ],
)
def test_version_from_name(spark, path, version):
    assert one(paths(spark, path).select(manifest.version_from_name(F.col("path"))))[0] == version


def test_last_path_wins_per_version_and_versions_union(spark):
    files = paths(spark, "/z/2_v1.zip", "/z/1_v1.zip", "/z/3_v2.zip")
    got = manifest.one_path_per_version(files)
    assert rows(got) == [("v1", "/z/2_v1.zip"), ("v2", "/z/3_v2.zip")]
    extra = spark.createDataFrame([("v0",), ("v1",)], "version string")
    assert [r[0] for r in manifest.known_versions(got, extra).collect()] == ["v0", "v1", "v2"]


def test_unchanged_payload_keeps_its_version(spark, tmp_path):
    for name, content in {"a.zip": b"same", "b.zip": b"same", "c.zip": b"other"}.items():
        (tmp_path / name).write_bytes(content)
    got = {r.path.rsplit("/", 1)[1]: r.version for r in manifest.payload_versions(spark, str(tmp_path)).collect()}
    assert got["a.zip"] == got["b.zip"] == hashlib.sha256(b"same").hexdigest()[:12]
    assert got["c.zip"] != got["a.zip"]


def test_snapshots_of_whole_and_fractional_polls_load_together(spark, tmp_path):
    """Integer delays, double delays and all-missing text land with one schema."""
    landing = str(tmp_path / "landing")
    flat = T.StructType([f for f in schemas.TRIP_UPDATES.fields if f.name != "dt"])
    for kind in ("int", "double"):
        poll = updates_df(spark, {"route_id": None}).drop("dt")
        poll = poll.withColumn("arrival_delay_seconds", F.col("arrival_delay_seconds").cast(kind))
        assert tables.append_snapshot(poll, landing, schemas.TRIP_UPDATES) == 1
    got = realtime.read_snapshots(spark, landing, schemas.TRIP_UPDATES)
    assert rows(got.select("arrival_delay_seconds", "route_id", "dt")) == [
        (10.0, None, dt.date(2026, 9, 16))
    ] * 2
    assert flat.names == got.drop("dt").columns


def test_batch_append_takes_each_file_once(spark, tmp_path):
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    load = lambda **k: realtime.append_new_files(spark, landing, bronze, schemas.SERVICE_ALERTS, **k)
    assert load() == []
    # Two files of one instant: both load.
    for name in ("a1", "a2"):
        tables.append_snapshot(alerts_df(spark, {"entity_id": name}).drop("dt"), landing, schemas.SERVICE_ALERTS)
    assert len(load()) == 2 and load() == []
    late = alerts_df(spark, {"entity_id": "old", "_ingested_at": at("2026-09-01T00:00:00")}).drop("dt")
    tables.append_snapshot(late, landing, schemas.SERVICE_ALERTS)
    assert load(since=dt.date(2026, 9, 10)) == []
    assert len(load()) == 1
    got = realtime.read_snapshots(spark, bronze, schemas.SERVICE_ALERTS)
    assert rows(got.select("entity_id", "dt")) == [
        ("a1", dt.date(2026, 9, 16)),
        ("a2", dt.date(2026, 9, 16)),
        ("old", dt.date(2026, 9, 1)),
    ]


def test_day_filters_prune_folders(spark, tmp_path):
    landing = str(tmp_path / "landing")
    tables.append_snapshot(updates_df(spark, {}).drop("dt"), landing, schemas.TRIP_UPDATES)
    got = realtime.read_snapshots(spark, landing, schemas.TRIP_UPDATES).filter("dt = DATE '2026-09-16'")
    assert "PartitionFilters: [isnotnull(dt" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 1


def test_csv_extract_quotes_text(spark, tmp_path):
    df = spark.createDataFrame([('Trains run "late", mostly', None, 1.5)], "a string, b string, c double")
    path = tables.export_csv({"x": df}, str(tmp_path))["x"]
    back = spark.read.option("header", True).option("escape", '"').schema(df.schema).csv(path)
    assert back.columns == ["a", "b", "c"] and rows(back) == rows(df)


def test_write_table_counts_rows_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_table(spark.range(7), path) == 7
    assert tables.write_table(spark.range(3).selectExpr("id", "id % 2 AS p"), path, ["p"]) == 3
    assert spark.read.parquet(path).count() == 3
