"""The whole pipeline over small landed files, run again as more arrive."""

import datetime as dt
import json

import pytest
from conftest import at, rows

from headway import jobs
from headway.plans import marts
from headway.sinks.ledger import Ledger
from headway.sinks.upsert import UpsertTable
from headway.sources import static

STATIC = {
    "routes": "route_id,route_short_name,route_long_name,route_type,agency_id\nr1,T1,One,2,op\nrx,,Depot,2,op\n",
    "stops": "stop_id,stop_name,stop_lat,stop_lon,parent_station\ns1,First,1,2,\ns2,Second,1,2,\n",
    "trips": "trip_id,route_id,service_id,trip_headsign\nt1,r1,wk,City\n",
    "stop_times": "trip_id,stop_id,stop_sequence,arrival_time,departure_time\nt1,s1,1,08:00:00,08:01:00\n",
    "calendar": "service_id,monday,start_date,end_date\nwk,1,20240910,20240912\n",
}


def land_static(landing, version, **changes):
    folder = landing / "gtfs_static" / version
    folder.mkdir(parents=True)
    for table, text in {**STATIC, **changes}.items():
        (folder / f"{table}.txt").write_text(text)


def land_poll(spark, tmp_path, landing, feed, name, ingested, *entities):
    path = tmp_path / f"{name}.json"
    path.write_text(json.dumps({"header": {"timestamp": 1726000000}, "entity": entities, "_ingested_at": ingested}))
    return jobs.land_messages(spark, feed, str(path), str(landing))


def trip(trip_id, *stops, route="r1"):
    updates = [{"stop_id": s, "stop_sequence": 1, "arrival": {"delay": d}} for s, d in stops]
    return {"id": f"e-{trip_id}", "trip_update": {"trip": {"trip_id": trip_id, "route_id": route}, "stop_time_update": updates}}


def test_pipeline(spark, tmp_path):
    landing = tmp_path / "landing"
    w = jobs.Warehouse(spark, str(tmp_path / "warehouse"))
    with pytest.raises(FileNotFoundError):
        jobs.run(w, str(landing))

    land_static(landing, "v1")
    updates, alerts = "gtfs_rt_trip_updates", "gtfs_service_alerts"
    first = (trip("t1", ("s1", 60), ("s2", 400)), trip("t2", ("s1", 30)), {"id": "vehicle"})
    assert land_poll(spark, tmp_path, landing, updates, "p1", "2024-09-10T20:30:00Z", *first) == 3
    alert = {
        "id": "a1",
        "alert": {
            "cause": 9,
            "header_text": {"translation": [{"text": "Works"}]},
            "active_period": [{"start": 1725990000, "end": 1726010000}],
            "informed_entity": [{"route_id": "r1"}],
        },
    }
    for n in (1, 2):
        stamp = f"2024-09-10T20:3{n}:00Z"
        assert land_poll(spark, tmp_path, landing, alerts, f"a{n}", stamp, alert) == 1
    jobs.run(w, str(landing))

    columns = ["trip_id", "stop_id", "arrival_delay_seconds", "is_orphan_trip"]
    assert rows(w.fact.read().select(columns)) == [
        ("t1", "s1", 60.0, False),
        ("t1", "s2", 400.0, False),
        ("t2", "s1", 30.0, True),
    ]
    mart = w.table("mart_route_daily_performance")
    assert rows(mart) == [(20240910, "r1", "T1", "train", 2, 1, 0, 50.0, 230.0)]
    assert w.table("fact_service_alerts").count() == 1

    # Running again changes nothing; a newer report and a later timetable do.
    jobs.run(w, str(landing))
    assert w.fact.read().count() == 3
    land_static(landing, "v2", trips=STATIC["trips"] + "t2,r1,wk,Back\n")
    land_poll(spark, tmp_path, landing, updates, "p2", "2024-09-10T20:45:00Z", trip("t1", ("s2", 100)))
    jobs.run(w, str(landing))
    assert rows(w.fact.read().select(columns)) == [
        ("t1", "s1", 60.0, False),
        ("t1", "s2", 100.0, False),
        ("t2", "s1", 30.0, False),
    ]
    assert rows(w.table("mart_line_delay_concentration"))[0][2:] == (190.0, 3.2, 3, 100.0, 100.0)
    impact = w.table("mart_alert_delay_impact").select("observations_during_alert")
    assert rows(impact) == [(3,)]

    report, fresh, problems = jobs.check(w, at("2024-09-10T21:30:00"))
    assert rows(report.filter("status <> 'pass'")) == []
    assert rows(fresh.select("status")) == [("warn",), ("warn",)]
    assert problems.isEmpty()
    assert rows(jobs.report_findings(w)["coverage_by_day"]) == [("20240910", 3, 0)]
    exported = jobs.extract(w, str(tmp_path / "extracts"))
    assert len(exported) == 8
    fact = spark.read.option("header", True).csv(exported["fact_trip_stop_performance"])
    assert fact.count() == 3 and "trip_id" in fact.columns
    names = jobs.create_views(w)
    assert {"stg_gtfs_static_routes", "int_trip_stop_performance", "dim_route"} <= set(names)
    worst = "SELECT route_id FROM mart_route_daily_performance ORDER BY pct_on_time LIMIT 10"
    assert rows(spark.sql(worst)) == [("r1",)]
    headsigns = "SELECT trip_headsign FROM int_trip_stop_performance WHERE NOT is_orphan_trip"
    assert rows(spark.sql(headsigns)) == [("Back",), ("City",), ("City",)]


def test_feeds_that_never_landed_leave_empty_tables(spark, tmp_path):
    landing = tmp_path / "landing"
    w = jobs.Warehouse(spark, str(tmp_path / "warehouse"))
    land_static(landing, "v1")
    jobs.run(w, str(landing))
    assert w.fact.read().isEmpty() and w.table("mart_alert_delay_impact").isEmpty()
    assert w.table("dim_stop").count() == 2
    land_poll(
        spark, tmp_path, landing, "gtfs_rt_trip_updates", "p1", "2024-09-10T20:30:00Z", trip("t1", ("s1", 60))
    )
    jobs.run(w, str(landing))
    assert w.fact.read().count() == 1


def test_totals_are_refreshed_for_changed_days_only(spark, tmp_path, monkeypatch):
    """And the marts built from them equal the marts built from the fact."""
    landing = tmp_path / "landing"
    w = jobs.Warehouse(spark, str(tmp_path / "warehouse"))
    monkeypatch.setattr(jobs, "CLOCK_MARGIN", dt.timedelta(0))
    land_static(landing, "v1")
    updates = "gtfs_rt_trip_updates"
    for day, delay in (("10", 60), ("11", 400)):
        entity = trip("t1", ("s1", delay), ("s2", 5))
        entity["trip_update"]["trip"]["start_date"] = f"202409{day}"
        land_poll(spark, tmp_path, landing, updates, f"p{day}", f"2024-09-{day}T20:30:00Z", entity)
    jobs.run(w, str(landing))
    files = lambda day: {
        p.name for p in (tmp_path / f"warehouse/gold/day_totals/service_date=202409{day}").glob("*.parquet")
    }
    before = files("10"), files("11")
    late = trip("t1", ("s1", 500), ("s3", 7))
    late["trip_update"]["trip"]["start_date"] = "20240911"
    land_poll(spark, tmp_path, landing, updates, "p3", "2024-09-11T21:30:00Z", late)
    jobs.run(w, str(landing))
    assert files("10") == before[0] and files("11") != before[1]

    fact, routes, stops = w.fact.read(), w.table("dim_route"), w.table("dim_stop")
    direct = {
        "mart_route_daily_performance": marts.route_daily_performance(fact, routes),
        "mart_stop_daily_performance": marts.stop_daily_performance(fact, stops),
        "mart_line_delay_concentration": marts.line_delay_concentration(fact, routes),
    }
    for name, expected in direct.items():
        assert rows(w.table(name)) == rows(expected)
    assert rows(w.table("mart_route_daily_performance"))[1][4:] == (3, 1, 0, 66.7, 170.7)


def crash(monkeypatch, owner, name, when):
    """Let `owner.name` run, and die after the first call that `when` accepts."""
    original = getattr(owner, name)

    def dies(*args, **kwargs):
        result = original(*args, **kwargs)
        if when(*args):
            raise RuntimeError("lost")
        return result

    monkeypatch.setattr(owner, name, dies)


STEPS = {
    "after the trips of the new version": (static, "load_static_versions", lambda spark, landing, bronze, table, new: table == "trips"),
    "after loading": (jobs, "load_bronze", lambda *a: True),
    "after the new rows": (jobs, "upsert_files", lambda *a: True),
    "after the repair, before it is recorded": (UpsertTable, "upsert", lambda *a: True),
    "after the repair is recorded": (Ledger, "record", lambda self, scope, items, state: scope == "trips"),
}


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_died_is_made_up_for_by_the_next(spark, tmp_path, monkeypatch, step):
    landing, updates = tmp_path / "landing", "gtfs_rt_trip_updates"
    w = jobs.Warehouse(spark, str(tmp_path / "warehouse"))
    land_static(landing, "v1")
    land_poll(spark, tmp_path, landing, updates, "p1", "2024-09-10T20:30:00Z", trip("t1", ("s1", 60)), trip("t2", ("s1", 30)))
    jobs.load_bronze(w, str(landing))
    jobs.update_fact(w)
    flags = lambda: rows(w.fact.read().select("trip_id", "is_orphan_trip"))
    assert flags() == [("t1", False), ("t2", True)]

    land_static(landing, "v2", trips=STATIC["trips"] + "t2,r1,wk,Back\n")
    with monkeypatch.context() as broken:
        crash(broken, *STEPS[step])
        with pytest.raises(Exception, match="lost"):
            jobs.load_bronze(w, str(landing))
            jobs.update_fact(w)
            raise RuntimeError("lost")
    again = jobs.Warehouse(spark, w.root)
    jobs.load_bronze(again, str(landing))
    jobs.update_fact(again)
    assert flags() == [("t1", False), ("t2", False)]
    assert jobs.apply_timetables(again) == []


def test_all_findings_and_checks_are_stored(spark, tmp_path, capsys, monkeypatch):
    landing, updates = tmp_path / "landing", "gtfs_rt_trip_updates"
    w = jobs.Warehouse(spark, str(tmp_path / "warehouse"))
    land_static(landing, "v1")
    days = [dt.date(2024, 9, 10) + dt.timedelta(days=k) for k in range(60)]
    entities = []
    for day in days:
        entity = trip("t1", ("s1", 60))
        entity["trip_update"]["trip"]["start_date"] = f"{day:%Y%m%d}"
        entities.append(entity)
    land_poll(spark, tmp_path, landing, updates, "p", "2024-09-10T20:30:00Z", *entities)
    jobs.run(w, str(landing))
    paths = jobs.store_findings(w)
    assert spark.read.parquet(paths["coverage_by_day"]).count() == 60
    paths, passed = jobs.store_check(w, at("2024-09-10T21:00:00"))
    fresh = {r.source: r.status for r in spark.read.parquet(paths["source_freshness"]).collect()}
    assert fresh["gtfs_service_alerts"] == "error" and not passed


def test_the_training_job_replaces_the_score_table(spark, tmp_path):
    landing = tmp_path / "landing"
    w = jobs.Warehouse(spark, str(tmp_path / "warehouse"))
    trips = "trip_id,route_id,service_id,trip_headsign\n" + "".join(f"t{i},r1,wk,City\n" for i in range(60))
    land_static(landing, "v1", trips=trips)
    late = [trip(f"t{i}", ("s1", 400 if i % 2 else 30)) for i in range(60)]
    land_poll(spark, tmp_path, landing, "gtfs_rt_trip_updates", "p1", "2024-09-10T20:30:00Z", *late)
    jobs.run(w, str(landing))
    for recent in (False, True):
        chosen = jobs.train_risk(w, trees=3, max_iter=5, max_depth=3, recent=recent)
        assembled = chosen.model.stages[2].getInputCols()
        assert ("recent_avg_delay_seconds" in assembled) == recent
        scores = spark.read.parquet(w.gold("mart_trip_delay_risk_score"))
        assert scores.count() == scores.select("trip_id").distinct().count() == 60
        assert rows(scores.select("actual_is_late", "model_name").distinct()) == [(0, chosen.name), (1, chosen.name)]
