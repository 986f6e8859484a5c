import itertools

import pytest
from conftest import at, rows, trips_df, updates_df

from headway import schemas
from headway.plans import silver, star
from headway.sinks import upsert as up
from headway.sinks.ledger import Ledger


def fact(spark, *items, trips=("t1",)):
    snapshot = silver.latest_snapshot(updates_df(spark, *items))
    return star.fact_trip_stop(silver.match_trips(snapshot, trips_df(spark, *trips)))


def item(day, stop, delay, ingested):
    return {
        "start_date": day,
        "stop_id": stop,
        "arrival_delay_seconds": delay,
        "_ingested_at": at(f"2026-09-{ingested}"),
    }


BATCHES = [
    [item("20260916", "a", 1.0, "16T08:00:00"), item("20260916", "b", 1.0, "16T08:00:00")],
    [item("20260916", "a", 2.0, "16T09:00:00"), item("20260917", "a", 5.0, "17T09:00:00")],
    [item("20260916", "a", 9.0, "16T07:00:00"), item("20260915", "z", 7.0, "16T07:30:00")],
]
FINAL = [
    ("20260915", "z", 7.0),
    ("20260916", "a", 2.0),
    ("20260916", "b", 1.0),
    ("20260917", "a", 5.0),
]


@pytest.fixture
def table(spark, tmp_path):
    return up.UpsertTable(spark, str(tmp_path / "fact"))


def contents(table):
    return rows(table.read().select("service_date", "stop_id", "arrival_delay_seconds"))


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_any_order_and_repeats_give_the_same_table(spark, table, order):
    for i in [*order, order[0]]:
        table.upsert(fact(spark, *BATCHES[i]))
    assert contents(table) == FINAL
    assert table.read().schema.names == schemas.FACT_TRIP_STOP.names
    assert [f.dataType for f in table.read().schema] == [f.dataType for f in schemas.FACT_TRIP_STOP]


def test_high_water_mark_skips_late_rows(spark, table):
    for batch in BATCHES:
        table.upsert(fact(spark, *batch), mode=up.HIGH_WATER_MARK)
    assert contents(table) == FINAL[1:]


def test_an_empty_table_with_a_high_water_mark_still_loads(spark, table):
    table.upsert(fact(spark, *BATCHES[0]).limit(0), mode=up.HIGH_WATER_MARK)
    assert contents(table) == []
    table.upsert(fact(spark, *BATCHES[0]), mode=up.HIGH_WATER_MARK)
    assert len(contents(table)) == 2


def test_unknown_mode(spark, table):
    with pytest.raises(ValueError):
        table.upsert(fact(spark, *BATCHES[0]), mode="newest")


def test_untouched_partitions_are_not_rewritten(spark, table, tmp_path):
    table.upsert(fact(spark, *BATCHES[0]))
    files = lambda: {p.name for p in (tmp_path / "fact/service_date=20260916").glob("*.parquet")}
    before = files()
    table.upsert(fact(spark, item("20260920", "a", 1.0, "20T08:00:00")))
    assert files() == before
    table.upsert(fact(spark, item("20260916", "c", 1.0, "20T08:00:00")))
    assert files().isdisjoint(before)


def test_rows_without_a_service_date(spark, table):
    undated = {**item("", "a", 1.0, "16T08:00:00"), "feed_timestamp": None}
    table.upsert(fact(spark, undated, *BATCHES[0]))
    table.upsert(fact(spark, {**undated, "arrival_delay_seconds": 4.0}))
    assert contents(table)[-1] == (None, "a", 4.0) and len(contents(table)) == 3


@pytest.mark.parametrize("copied", [False, True])
def test_a_run_that_died_while_copying_is_finished_by_the_next(spark, table, monkeypatch, copied):
    table.upsert(fact(spark, *BATCHES[0]))

    def die(self, attempt):
        if copied:
            self._write(self._load(self._staging), self.path, dynamic=True)
        raise RuntimeError("executor lost")

    with monkeypatch.context() as broken:
        broken.setattr(up.UpsertTable, "_apply", die)
        with pytest.raises(RuntimeError):
            table.upsert(fact(spark, *BATCHES[1]))
    table.upsert(fact(spark, *BATCHES[2]))
    assert contents(table) == FINAL


def test_a_run_that_died_before_staging_leaves_the_table_alone(spark, table, monkeypatch):
    table.upsert(fact(spark, *BATCHES[0]))
    with monkeypatch.context() as broken:
        broken.setattr(Ledger, "record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.upsert(fact(spark, *BATCHES[1]))
    assert len(contents(table)) == 2
    for batch in BATCHES[1:]:
        table.upsert(fact(spark, *batch))
    assert contents(table) == FINAL


def test_late_timetable_clears_orphans(spark, table):
    table.upsert(fact(spark, {"trip_id": "t1"}, {"trip_id": "t2"}, {"trip_id": "t3"}))
    corrected = up.refreshed_orphans(table.read(), trips_df(spark, "t2"))
    table.upsert(corrected)
    got = table.read().select("trip_id", "is_orphan_trip")
    assert rows(got) == [("t1", False), ("t2", False), ("t3", True)]


def test_existing_rows_are_read_by_partition(spark, table, tmp_path):
    table.upsert(fact(spark, *BATCHES[0]))
    fact(spark, *BATCHES[1]).write.parquet(str(tmp_path / "incoming"))
    incoming = table._load(str(tmp_path / "incoming"))
    plan = table._touched(incoming)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
