"""Every registered query against its SQL, and known values of the given tables."""

import os

import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from checks.compare import difference, oracle_connection
from checks.oracles import ORACLES
from checks.registry import all_queries

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# No SQL counterpart: a hash DuckDB lacks, and fitted models.
WITHOUT_ORACLE = {"surrogate_keys", "risk_class_report", "risk_scores"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


def test_oracles_cover_the_queries():
    assert set(all_queries()) - set(ORACLES) == WITHOUT_ORACLE
    assert set(ORACLES) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    df = all_queries()[name](spark, SMALL)
    assert difference(df, con, ORACLES[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Cartesian", "NestedLoop"):
        assert node not in plan


@pytest.mark.parametrize("name", sorted(WITHOUT_ORACLE))
def test_query_runs(spark, name):
    assert not all_queries()[name](spark, SMALL).isEmpty()


def medium(spark, name):
    return all_queries()[name](spark, MEDIUM)


def test_known_summary(spark):
    got = one(medium(spark, "silver_summary"))
    assert (got.total_rows, got.orphan_rows, got.outlier_rows) == (8045, 1844, 738)


def test_known_route_day(spark):
    daily = medium(spark, "route_daily_performance")
    assert daily.count() == 720
    got = one(daily.filter("date_key = 20240101 AND route_id = '0'"))
    assert tuple(got)[4:] == (12, 5, 3, 58.3, 129.3)


def test_known_line(spark):
    lines = medium(spark, "line_delay_concentration")
    assert lines.count() == 24
    got = one(lines.filter("route_short_name = 'NATION_0'"))
    assert tuple(got)[2:] == (114740.0, 1912.3, 269, 4.2, 68.8)


def test_known_alert_impact(spark):
    impact = medium(spark, "alert_delay_impact")
    assert impact.count() == 50
    got = one(impact.filter("route_id = '0' AND header_text = 'Alert 0'"))
    assert tuple(got)[4:] == (56, 323.6, 259.4, 64.2)


def test_known_coverage_and_line_punctuality(spark):
    day = medium(spark, "coverage_by_day").filter("service_date = '20240101'")
    assert rows(day) == [("20240101", 221, 64)]
    line = one(medium(spark, "on_time_by_line").filter("route_short_name = 'NATION_0'"))
    assert (round(line.pct_on_time, 9), line.n) == (57.458563536, 181)


def test_known_alert_flags(spark):
    flags = medium(spark, "risk_training_set").agg(F.count(F.lit(1)), F.sum("had_active_alert"))
    assert tuple(one(flags)) == (5880, 2154)
