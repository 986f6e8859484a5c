"""The products on random data with nulls, blanks, ties and repeats, against plain SQL."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from conftest import alerts_df, routes_df, rows, trips_df, updates_df

from headway.plans import findings, marts, risk, silver, staging, star

DAY = dt.datetime(2026, 9, 16)

FACT = """
CREATE VIEW fact AS
SELECT TRY_CAST(service_date AS INTEGER) AS date_key, service_date, route_id, stop_id, u.trip_id,
  stop_sequence, arrival_delay_seconds AS delay, arrival_delay_seconds > 300 AS is_late,
  schedule_relationship = 'CANCELED' AS is_cancelled, t.trip_id IS NULL AS is_orphan_trip,
  (arrival_delay_seconds < -600 OR arrival_delay_seconds > 7200) AS is_delay_outlier, feed_timestamp
FROM (SELECT *, coalesce(nullif(start_date, ''), strftime(feed_timestamp, '%Y%m%d')) AS service_date
      FROM updates
      QUALIFY row_number() OVER (PARTITION BY service_date, trip_id, stop_id, stop_sequence
        ORDER BY _ingested_at DESC, feed_timestamp DESC NULLS LAST, entity_id DESC) = 1) u
LEFT JOIN trips t ON u.trip_id = t.trip_id;
CREATE VIEW dim AS SELECT *, CASE route_type WHEN 2 THEN 'train' WHEN 3 THEN 'bus' WHEN 4 THEN 'ferry'
  WHEN 0 THEN 'light_rail' ELSE 'other' END AS mode FROM routes;
"""

ROUTE_DAY = """
SELECT date_key, r.route_id, route_short_name, mode, count(*), coalesce(sum(is_late::INT), 0),
  coalesce(sum(is_cancelled::INT), 0),
  round(100.0::DOUBLE * count(*) FILTER (WHERE NOT is_late) / count(*), 1), round(avg(delay), 1)
FROM fact f JOIN dim r ON f.route_id IS NOT DISTINCT FROM r.route_id
WHERE NOT is_orphan_trip AND route_short_name IS NOT NULL GROUP BY ALL
"""

CONCENTRATION = """
SELECT route_short_name, mode, total, n,
  round(100.0::DOUBLE * total / nullif(sum(total) OVER (), 0), 1),
  round(100.0::DOUBLE * sum(total) OVER (ORDER BY total DESC, route_short_name, mode
    ROWS UNBOUNDED PRECEDING) / nullif(sum(total) OVER (), 0), 1)
FROM (SELECT route_short_name, mode, sum(greatest(delay, 0)) AS total, count(*) AS n
  FROM fact f JOIN dim r ON f.route_id IS NOT DISTINCT FROM r.route_id
  WHERE NOT is_orphan_trip AND route_short_name IS NOT NULL GROUP BY ALL)
"""

IMPACT = """
WITH w AS (SELECT DISTINCT route_id, header_text, cause, effect, active_period_start AS a,
    active_period_end AS b FROM alerts
  WHERE route_id <> '' AND active_period_start IS NOT NULL AND active_period_end IS NOT NULL),
d AS (SELECT w.route_id, header_text, cause, effect, count(*) AS n, avg(delay) AS during
  FROM w JOIN fact f ON f.route_id = w.route_id AND f.feed_timestamp BETWEEN a AND b
  WHERE NOT is_orphan_trip GROUP BY ALL),
base AS (SELECT r.route_id, avg(delay) AS baseline FROM fact f JOIN dim r ON f.route_id = r.route_id
  WHERE NOT is_orphan_trip GROUP BY ALL)
SELECT d.route_id, header_text, cause, effect, n, round(during, 1), round(baseline, 1),
  round(during - baseline, 1) FROM d JOIN base ON d.route_id = base.route_id
"""

FEATURES = """
SELECT f.trip_id, f.stop_id, f.service_date, route_short_name, hour(feed_timestamp),
  EXISTS (SELECT 1 FROM alerts a WHERE a.route_id <> '' AND a.route_id = f.route_id
    AND f.feed_timestamp BETWEEN a.active_period_start AND a.active_period_end)::INT, is_late::INT
FROM fact f JOIN dim r ON f.route_id IS NOT DISTINCT FROM r.route_id
WHERE NOT is_orphan_trip AND is_late IS NOT NULL
"""

COVERAGE = """
SELECT service_date, count(*) FILTER (WHERE NOT is_orphan_trip), count(*) FILTER (WHERE is_orphan_trip)
FROM fact GROUP BY service_date
"""


def moment(rng):
    return DAY + dt.timedelta(minutes=rng.choice([0, 60, 120, rng.randrange(0, 3000)]))


def utc(value):
    return None if value is None else value.replace(tzinfo=dt.timezone.utc)


def random_updates(rng, n):
    return [
        {
            "entity_id": f"e{i}",
            "trip_id": rng.choice(["hot"] * 5 + ["t1", "t2", "ghost", "", None]),
            "route_id": rng.choice(["r1"] * 5 + ["r2", "r3", "rx", "gone", "", None]),
            "start_date": rng.choice(["", "", None, "20260916", "20260917", "odd"]),
            "schedule_relationship": rng.choice(["SCHEDULED", "SCHEDULED", "CANCELED", None]),
            "stop_id": rng.choice(["a", "b", "c", "d", "", None]),
            "stop_sequence": rng.choice([0, 0, 1, 2, None]),
            "arrival_delay_seconds": rng.choice([None, 0.0, 300.0, 301.0, -900.0, 9000.0, float(rng.randrange(-300, 900))]),
            "feed_timestamp": rng.choice([None] + [moment(rng)] * 8),
            "_ingested_at": moment(rng),
        }
        for i in range(n)
    ]


def random_alerts(rng, n):
    return [
        {
            "entity_id": f"a{i % 30}",
            "cause": rng.choice(["MAINTENANCE", None]),
            "effect": "DETOUR",
            "header_text": rng.choice(["one", "two", None]),
            "route_id": rng.choice(["r1", "r1", "r1", "r2", "rx", "gone", "", None]),
            "active_period_start": rng.choice([None] + [moment(rng)] * 8),
            "active_period_end": rng.choice([None] + [moment(rng)] * 8),
            "_ingested_at": moment(rng),
        }
        for i in range(n)
    ]


ROUTES = [("r1", "T1", 2), ("r2", "T1", 2), ("r3", "T2", 3), ("rx", None, 2), (None, "T9", 7)]


def sql(con, text):
    def plain(v):
        return None if v is None or v is pd.NaT or v is pd.NA else v

    return sorted((tuple(plain(v) for v in r) for r in con.execute(text).fetchall()), key=repr)


def table(con, name, items, types):
    columns = ", ".join(f"{n} {t}" for n, t in types.items())
    con.execute(f"CREATE TABLE {name} ({columns})")
    con.executemany(
        f"INSERT INTO {name} VALUES ({', '.join('?' * len(types))})",
        [[i.get(n) for n in types] for i in items],
    )


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_products_on_random_data(spark, seed):
    rng = random.Random(seed)
    updates, alerts = random_updates(rng, 500), random_alerts(rng, 60)
    con = duckdb.connect()
    text, number, time = "VARCHAR", "DOUBLE", "TIMESTAMP"
    table(
        con, "updates", updates,
        dict(entity_id=text, trip_id=text, route_id=text, start_date=text, schedule_relationship=text,
             stop_id=text, stop_sequence="BIGINT", arrival_delay_seconds=number, feed_timestamp=time,
             _ingested_at=time),
    )
    table(
        con, "alerts", alerts,
        dict(route_id=text, header_text=text, cause=text, effect=text, active_period_start=time,
             active_period_end=time),
    )
    table(con, "routes", [dict(zip(("route_id", "route_short_name", "route_type"), r)) for r in ROUTES],
          dict(route_id=text, route_short_name=text, route_type="INTEGER"))
    table(con, "trips", [{"trip_id": t} for t in ("hot", "t1", "t2", "")], dict(trip_id=text))
    con.execute(FACT)

    times = ("feed_timestamp", "_ingested_at", "active_period_start", "active_period_end")
    zoned = lambda items: [{k: utc(v) if k in times else v for k, v in i.items()} for i in items]
    snapshot = silver.latest_snapshot(staging.trip_updates(updates_df(spark, *zoned(updates))))
    fact = star.fact_trip_stop(silver.match_trips(snapshot, trips_df(spark, "hot", "t1", "t2", "")))
    routes = star.dim_route(routes_df(spark, *ROUTES))
    fact_alerts = star.fact_service_alerts(
        staging.service_alerts(alerts_df(spark, *zoned(alerts)))
    )

    assert rows(marts.route_daily_performance(fact, routes)) == sql(con, ROUTE_DAY)
    assert rows(
        marts.line_delay_concentration(fact, routes).drop("total_delay_minutes")
    ) == sql(con, CONCENTRATION)
    assert rows(marts.alert_delay_impact(fact, routes, fact_alerts)) == sql(con, IMPACT)
    features = risk.training_set(fact, routes, fact_alerts).select(
        "trip_id", "stop_id", "service_date", "route_short_name", "hour_of_day", "had_active_alert", "is_late"
    )
    assert rows(features) == sql(con, FEATURES)
    assert rows(findings.coverage_by_day(fact)) == sql(con, COVERAGE)

    # The same from totals of the fact.
    days, instants = (
        marts.totals(fact, *keys) for keys in (marts.DAY_TOTALS, marts.INSTANT_TOTALS)
    )
    assert rows(marts.route_daily_performance(days, routes)) == sql(con, ROUTE_DAY)
    assert rows(marts.alert_delay_impact(instants, routes, fact_alerts)) == sql(con, IMPACT)
