"""Landed files whose columns have other types than declared, or none, or that can't be read."""

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows

from headway import jobs, schemas
from headway.sources import realtime
from headway.sources.footers import FILES, landed_types
from headway.streaming import ingest

DAY = dt.date(2026, 9, 16)
WHEN = pd.Timestamp("2026-09-16T08:00:00", tz="UTC")


def frame(name, delays, **more):
    base = {
        "entity_id": [f"{name}{i}" for i in range(len(delays))],
        "trip_id": "t1",
        "stop_sequence": 1,
        "arrival_delay_seconds": delays,
        "_ingested_at": WHEN,
    }
    return pa.Table.from_pandas(pd.DataFrame({**base, **more}), preserve_index=False)


def land(landing, name, table, **options):
    folder = landing / f"dt={DAY}"
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(table, folder / f"{name}.parquet", **options)
    return folder / f"{name}.parquet"


@pytest.fixture
def load(spark, tmp_path):
    landing, bronze, log = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "log")

    def run(**options):
        ingest.ingest_files(spark, str(landing), bronze, log, schemas.TRIP_UPDATES, **options).awaitTermination()
        got = realtime.read_snapshots(spark, bronze, schemas.TRIP_UPDATES)
        bad = ingest.read_quarantine(spark, bronze)
        return (
            dict(got.select("entity_id", "arrival_delay_seconds").collect()),
            {r.path.rsplit("/", 1)[-1]: r.problem for r in bad.collect()},
            got,
        )

    return landing, run


def test_types_are_told_file_by_file(load):
    landing, run = load
    land(landing, "doubles", frame("d", [1.5, None]))
    land(landing, "wholes", frame("w", np.array([3, 4], "int64")))
    land(landing, "narrow", frame("n", np.array([5], "int32"), stop_sequence=np.array([7], "int16")))
    land(landing, "nothing", frame("x", [None, None], stop_sequence=[1.0, None]))
    land(landing, "lacking", frame("l", [1.0]).drop_columns(["arrival_delay_seconds"]).append_column("other", pa.array([1])))
    (landing / f"dt={DAY}" / "damaged.parquet").write_bytes(b"PAR1 nothing of the kind")
    (landing / f"dt={DAY}" / "empty.parquet").write_bytes(b"")
    land(landing, "texts", frame("t", ["late"]))
    want = {"d0": 1.5, "d1": None, "w0": 3.0, "w1": 4.0, "n0": 5.0, "x0": None, "x1": None, "l0": None}
    values, bad, got = run()
    assert values == want and got.schema == schemas.TRIP_UPDATES
    assert sorted(bad) == ["damaged.parquet", "texts.parquet"]
    assert "arrival_delay_seconds: string instead of double" in bad["texts.parquet"]
    assert rows(got.select("dt").distinct()) == [(DAY,)]
    sequences = dict(got.select("entity_id", "stop_sequence").collect())
    assert (sequences["n0"], sequences["x0"], sequences["x1"]) == (7, 1, None)
    land(landing, "later", frame("z", [9.0]))
    values, after, _ = run()
    assert values == {**want, "z0": 9.0} and after == bad
    assert run()[0] == values


def test_damaged_pages_are_found_and_the_rest_is_loaded(load):
    landing, run = load
    for k in range(5):
        path = land(landing, f"f{k}", frame(f"f{k}-", np.arange(2000.0)), compression="gzip")
        if k in (1, 3):
            raw = bytearray(path.read_bytes())
            raw[4:900] = b"\0" * 896  # the footer stays whole
            path.write_bytes(bytes(raw))
    values, bad, _ = run()
    assert sorted(bad) == ["f1.parquet", "f3.parquet"]
    assert len(values) == 3 * 2000
    land(landing, "clean", frame("c", [1.0]))
    assert run()[0]["c0"] == 1.0


@pytest.mark.parametrize("unit", ["ns", "us", "ms"])
def test_times_in_any_unit(load, unit):
    landing, run = load
    table = frame("a", [1.0])
    at = table.schema.get_field_index("_ingested_at")
    table = table.set_column(at, "_ingested_at", table.column(at).cast(pa.timestamp(unit, tz="UTC")))
    land(landing, "a", table)
    _, bad, got = run()
    assert bad == {}
    assert rows(got.selectExpr("unix_seconds(_ingested_at)")) == [(int(WHEN.timestamp()),)]


def test_batch_delivered_again_replaces_what_it_wrote(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    land(landing, "a", frame("a", [1.0]))
    (landing / f"dt={DAY}" / "bad.parquet").write_bytes(b"x")
    files = spark.read.schema(FILES).format("binaryFile").option("recursiveFileLookup", True).load(str(landing))
    for _ in range(2):
        ingest.load_files(files, str(landing), bronze, schemas.TRIP_UPDATES)
    assert realtime.read_snapshots(spark, bronze, schemas.TRIP_UPDATES).count() == 1
    assert ingest.read_quarantine(spark, bronze).count() == 1


def test_only_footers_leave_the_scan(spark, tmp_path):
    path = land(tmp_path, "a", frame("a", np.random.default_rng(1).standard_normal(50000)))
    files = spark.read.schema(FILES).format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    from headway.sources.footers import footer
    from pyspark.sql import functions as F

    size = files.select(F.length(footer(F.col("content"))).alias("n")).first().n
    assert size < 8000 < path.stat().st_size
    assert landed_types(files, schemas.TRIP_UPDATES).first().problem is None


def test_fact_is_built_from_mixed_files(spark, tmp_path):
    """The load that once stopped for weeks: whole numbers beside fractions, through to the fact."""
    w = jobs.Warehouse(spark, str(tmp_path / "warehouse"))
    landing = tmp_path / "landing"
    (landing / "gtfs_static" / "v1").mkdir(parents=True)
    for name, schema in schemas.STATIC.items():
        values = {"trip_id": "t1", "route_id": "r1", "stop_id": "s1"}
        line = ",".join(values.get(f.name, "") for f in schema)
        (landing / "gtfs_static" / "v1" / f"{name}.txt").write_text(",".join(schema.names) + "\n" + line + "\n")
    feed = landing / "gtfs_rt_trip_updates"
    land(feed, "a", frame("a", np.array([400], "int64"), start_date="20260916", stop_id="s1", schedule_relationship="SCHEDULED"))
    land(feed, "b", frame("b", [None], start_date="20260916", stop_id="s2", schedule_relationship="SCHEDULED"))
    jobs.load_bronze(w, str(landing))
    jobs.update_fact(w)
    assert rows(w.fact.read().select("stop_id", "arrival_delay_seconds", "is_late")) == [("s1", 400.0, True), ("s2", None, None)]
