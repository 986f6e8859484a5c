import datetime as dt

from conftest import at, rows

from headway.operators import quality as q
from headway.plans.rules import ALL_RULES


def report(tables, *rules):
    got = q.check_rules(tables, rules).select("rule", "columns", "failures", "status")
    return {(r.rule, r.columns): (r.failures, r.status) for r in got.collect()}


def test_every_rule_kind(spark):
    child = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), (None, 3, "gone"), (None, 900, None), ("b", None, "gone")],
        "k string, v int, parent string",
    )
    parent = spark.createDataFrame([("x",)], "id string")
    got = report(
        {"child": child, "parent": parent},
        q.NotNull("child", ("k",)),
        q.Unique("child", ("k",)),
        q.Unique("child", ("k", "v")),
        q.AcceptedValues("child", ("v",), q.WARN, values=(1, 2, 3)),
        q.AcceptedRange("child", ("v",), low=1, high=900),
        q.Relationship("child", ("parent",), parent="parent", parent_column="id"),
    )
    assert got == {
        ("NotNull", "k"): (2, "fail"),
        ("Unique", "k"): (1, "fail"),
        ("Unique", "k,v"): (0, "pass"),
        ("AcceptedValues", "v"): (1, "warn"),
        ("AcceptedRange", "v"): (0, "pass"),
        ("Relationship", "parent"): (2, "fail"),
    }


def test_there_are_31_rules_and_replacement_trips_are_known():
    assert len(ALL_RULES) == 31
    accepted = [r for r in ALL_RULES if r.columns == ("schedule_relationship",)]
    assert "REPLACEMENT" in accepted[0].values


def test_row_rules_of_a_table_share_one_pass(spark):
    df = spark.range(10).selectExpr("id AS a", "id AS b")
    plan = q._row_rules(df, [q.NotNull("t", ("a",)), q.NotNull("t", ("b",))])
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Range") == 1


def test_freshness(spark):
    now = dt.datetime(2026, 9, 16, 10, 0)
    schema = "_ingested_at timestamp"
    sources = {
        name: spark.createDataFrame([(at(t),)], schema)
        for name, t in {
            "fresh": "2026-09-16T09:30:00",
            "late": "2026-09-16T09:29:59",
            "old": "2026-09-16T08:29:59",
        }.items()
    }
    sources["empty"] = spark.createDataFrame([], schema)
    got = {r.source: r.status for r in q.freshness(sources, at("2026-09-16T10:00:00")).collect()}
    assert got == {"fresh": "pass", "late": "warn", "old": "error", "empty": "error"}


def health(spark, *items, now="2026-09-16T10:00:00", **limits):
    fact = spark.createDataFrame(
        [(d, o, at(t)) for d, o, t in items],
        "service_date string, is_orphan_trip boolean, _ingested_at timestamp",
    )
    return rows(q.pipeline_health(fact, at(now), **limits))


def test_healthy(spark):
    assert health(spark, ("20260916", False, "2026-09-16T09:00:00")) == []


def test_stale(spark):
    assert health(spark, ("20260916", False, "2026-09-16T06:00:00")) == [("stale", None, 4.0)]


def test_orphan_rate_of_the_latest_day_only(spark):
    old = [("20260915", True, "2026-09-16T09:00:00")] * 9
    new = [("20260916", i < 3, "2026-09-16T09:00:00") for i in range(4)]
    assert health(spark, *old, *new, min_rows=4) == [("orphans", "20260916", 75.0)]
    assert health(spark, *old, *new, min_rows=5) == []
    assert health(spark, *old, *new, min_rows=4, max_orphan_pct=75.0) == []


def test_no_data_is_a_problem(spark):
    assert health(spark) == [("no_data", None, None)]
