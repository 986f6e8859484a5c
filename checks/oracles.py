"""The same results as SQL over the given tables."""

from __future__ import annotations

BASE = """
WITH ev AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events
),
updates AS (
  SELECT CAST(event_id AS VARCHAR) AS entity_id,
         CAST(user_id AS VARCHAR) AS trip_id,
         CAST(user_id % 25 AS VARCHAR) AS route_id,
         CASE WHEN event_id % 2 = 0 THEN '' ELSE strftime(ts, '%Y%m%d') END AS start_date,
         CASE WHEN event_type = 'signup' THEN 'CANCELED' ELSE 'SCHEDULED' END AS schedule_relationship,
         event_type AS stop_id,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS BIGINT) AS stop_sequence,
         CASE WHEN k >= 5 THEN CAST(round((value - 35.0::DOUBLE) * 20.0::DOUBLE) AS BIGINT) END AS delay,
         ts AS feed_timestamp, ts AS _ingested_at
  FROM ev
),
latest AS (
  SELECT *, coalesce(nullif(start_date, ''), strftime(feed_timestamp, '%Y%m%d')) AS service_date
  FROM updates
  QUALIFY row_number() OVER (PARTITION BY service_date, trip_id, stop_id, stop_sequence
                             ORDER BY _ingested_at DESC, entity_id DESC) = 1
),
trips AS (
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'x' ELSE '' END || c_custkey AS trip_id,
         c_name AS trip_headsign, c_mktsegment AS service_id
  FROM customer
),
stop_times AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, l_returnflag AS stop_id,
         CAST(l_linenumber AS BIGINT) AS stop_sequence,
         lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0') || ':00:00' AS arrival_time,
         lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0') || ':01:00' AS departure_time,
         lpad(CAST(l_partkey AS VARCHAR), 12, '0') || lpad(CAST(l_suppkey AS VARCHAR), 12, '0')
           AS _feed_version,
         l_shipdate AS _ingested_at
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate DESC, _feed_version DESC, stop_id, arrival_time) = 1
),
fact AS (
  SELECT TRY_CAST(service_date AS INTEGER) AS date_key, service_date, route_id, stop_id,
         l.trip_id, stop_sequence, schedule_relationship, delay,
         delay > 300 AS is_late, schedule_relationship = 'CANCELED' AS is_cancelled,
         t.trip_id IS NULL AS is_orphan_trip, (delay < -600 OR delay > 7200) AS is_delay_outlier,
         feed_timestamp, _ingested_at, trip_headsign, service_id
  FROM latest l LEFT JOIN trips t ON l.trip_id = t.trip_id
),
routes AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS route_id, nullif(n_name, 'NATION_24') AS route_short_name,
         n_name AS route_long_name,
         CASE n_regionkey WHEN 2 THEN 'train' WHEN 3 THEN 'bus' WHEN 4 THEN 'ferry'
              WHEN 0 THEN 'light_rail' ELSE 'other' END AS mode,
         r_name AS operator
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
stops AS (
  SELECT event_type AS stop_id, 'Stop ' || k AS stop_name, value AS stop_lat, -value AS stop_lon,
         strftime(ts, '%Y%m%d') AS _feed_version, ts AS _ingested_at
  FROM ev QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) = 1
),
all_alerts AS (
  SELECT CAST(event_id AS VARCHAR) AS alert_id,
         CASE k % 4 WHEN 0 THEN 'MAINTENANCE' WHEN 1 THEN 'WEATHER' WHEN 2 THEN 'ACCIDENT'
              ELSE 'STRIKE' END AS cause,
         CASE WHEN k % 4 = 0 THEN 'MODIFIED_SERVICE' ELSE 'DETOUR' END AS effect,
         'Alert ' || (k % 4) AS header_text, props AS description_text,
         CASE event_type WHEN 'error' THEN CAST(user_id % 25 AS VARCHAR) WHEN 'click' THEN NULL ELSE '' END
           AS route_id,
         ts AS active_period_start,
         CASE WHEN k % 2 = 0 THEN ts + INTERVAL 6 HOUR END AS active_period_end
  FROM ev
),
alerts AS (SELECT * FROM all_alerts WHERE route_id <> ''),
matched AS (SELECT * FROM fact WHERE NOT is_orphan_trip),
scored AS (
  SELECT f.*, r.route_short_name, r.mode
  FROM fact f JOIN routes r ON f.route_id = r.route_id
  WHERE is_orphan_trip = false AND is_delay_outlier = false AND is_cancelled = false
    AND r.route_short_name IS NOT NULL
),
windows AS (
  SELECT DISTINCT route_id, header_text, cause, effect, active_period_start, active_period_end
  FROM alerts WHERE active_period_start IS NOT NULL AND active_period_end IS NOT NULL
),
features AS (
  SELECT f.trip_id, f.stop_id, f.service_date, f.feed_timestamp, r.route_short_name, r.mode,
         CAST(hour(f.feed_timestamp) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(f.feed_timestamp) + 1 AS INTEGER) AS day_of_week_num,
         CAST(EXISTS (SELECT 1 FROM alerts a WHERE a.route_id = f.route_id
              AND a.active_period_start IS NOT NULL
              AND f.feed_timestamp BETWEEN a.active_period_start AND a.active_period_end)
              AS INTEGER) AS had_active_alert,
         CAST(f.is_late AS INTEGER) AS is_late
  FROM fact f JOIN routes r ON f.route_id = r.route_id
  WHERE NOT f.is_orphan_trip AND f.is_late IS NOT NULL
),
concentration AS (
  SELECT route_short_name, mode, CAST(total AS DOUBLE) AS total_delay_seconds,
         round(CAST(total AS DOUBLE) / 60.0::DOUBLE, 1) AS total_delay_minutes, trip_stop_count,
         round(CAST(total AS DOUBLE) * 100.0::DOUBLE / CAST(sum(total) OVER () AS DOUBLE), 1)
           AS pct_of_network_delay,
         round(CAST(sum(total) OVER (ORDER BY total DESC, route_short_name, mode
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) * 100.0::DOUBLE
               / CAST(sum(total) OVER () AS DOUBLE), 1) AS cumulative_pct_of_network_delay
  FROM (SELECT route_short_name, mode, sum(greatest(delay, 0)) AS total, count(*) AS trip_stop_count
        FROM matched JOIN routes USING (route_id) WHERE route_short_name IS NOT NULL
        GROUP BY route_short_name, mode)
),
route_day AS (
  SELECT date_key, route_id, route_short_name, mode, count(*) AS trip_stop_count,
         CAST(coalesce(sum(CAST(is_late AS INTEGER)), 0) AS BIGINT) AS late_count,
         CAST(sum(CAST(is_cancelled AS INTEGER)) AS BIGINT) AS cancelled_count,
         round(CAST(count(*) FILTER (WHERE NOT is_late) AS DOUBLE) * 100.0::DOUBLE / count(*), 1)
           AS pct_on_time,
         round(CAST(sum(delay) AS DOUBLE) / count(delay), 1) AS avg_arrival_delay_seconds
  FROM matched JOIN routes USING (route_id) WHERE route_short_name IS NOT NULL
  GROUP BY date_key, route_id, route_short_name, mode
),
impact AS (
  SELECT d.route_id, d.header_text, d.cause, d.effect, n AS observations_during_alert,
         round(during, 1) AS avg_delay_during_alert_seconds,
         round(baseline, 1) AS baseline_avg_delay_seconds,
         round(during - baseline, 1) AS delay_lift_seconds
  FROM (SELECT w.route_id, header_text, cause, effect, count(*) AS n,
               CAST(sum(delay) AS DOUBLE) / count(delay) AS during
        FROM windows w JOIN matched f ON f.route_id = w.route_id
         AND f.feed_timestamp BETWEEN w.active_period_start AND w.active_period_end
        GROUP BY ALL) d
  JOIN (SELECT route_id, CAST(sum(delay) AS DOUBLE) / count(delay) AS baseline
        FROM matched JOIN routes USING (route_id) GROUP BY route_id) b ON d.route_id = b.route_id
),
ranking AS (
  SELECT s.stop_id, stop_name,
         round(CAST(count(*) FILTER (WHERE NOT is_late) AS DOUBLE) * 100.0::DOUBLE / count(*), 1)
           AS pct_on_time,
         round(CAST(sum(delay) AS DOUBLE) / count(delay), 1) AS avg_delay_seconds,
         count(*) AS n
  FROM fact f JOIN stops s ON f.stop_id = s.stop_id
  WHERE is_orphan_trip = false AND is_delay_outlier = false AND is_cancelled = false
  GROUP BY s.stop_id, stop_name HAVING count(*) >= 30
)
"""

_PUNCTUALITY = """
  CAST(count(*) FILTER (WHERE NOT is_late) AS DOUBLE) * 100.0::DOUBLE / count(*) AS pct_on_time,
  CAST(sum(delay) AS DOUBLE) / count(delay) / 60.0::DOUBLE AS avg_delay_minutes,
  count(*) AS n
"""

_LOCAL = "timezone('Australia/Sydney', timezone('UTC', feed_timestamp))"


def _versions(key: str, table: str, columns: str, newest: str) -> str:
    return f"""SELECT {columns} FROM {table}
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {newest}) = 1"""


_TRIP_VERSIONS = _versions(
    "o_custkey",
    "orders",
    """CAST(o_custkey AS VARCHAR) AS trip_id, CAST(o_custkey % 25 AS VARCHAR) AS route_id,
       o_orderstatus AS service_id, o_orderpriority AS trip_headsign,
       lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS _feed_version, o_orderdate AS _ingested_at""",
    "o_orderdate DESC, o_orderkey DESC",
)


def _around(phase: str, condition: str) -> str:
    return f"""SELECT w.route_id, header_text, cause, effect, '{phase}' AS phase, count(*) AS observations,
      round(CAST(sum(delay) AS DOUBLE) / count(delay), 1) AS avg_delay_seconds
      FROM windows w JOIN matched f ON f.route_id = w.route_id AND {condition}
      GROUP BY w.route_id, header_text, cause, effect"""


ORACLES: dict[str, str] = {
    "stg_trip_updates": BASE
    + """SELECT entity_id, trip_id, route_id, start_date, schedule_relationship, stop_id, stop_sequence,
         CAST(delay AS DOUBLE) AS arrival_delay_seconds, CAST(delay AS DOUBLE) AS departure_delay_seconds,
         'SCHEDULED' AS stop_schedule_relationship, feed_timestamp, _ingested_at FROM updates""",
    "stg_service_alerts": BASE
    + """SELECT all_alerts.*, active_period_start + INTERVAL (m) MINUTE AS _ingested_at
         FROM all_alerts, (VALUES (0), (15)) polls(m)""",
    "stg_routes": _versions(
        "s_nationkey",
        "supplier",
        """CAST(s_nationkey AS VARCHAR) AS route_id, s_name AS route_short_name,
           'Line ' || s_nationkey AS route_long_name, CAST(s_suppkey % 6 AS INTEGER) AS route_type,
           'A' AS agency_id, lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS _feed_version,
           make_timestamp(CAST(round(s_acctbal) AS BIGINT) * 60000000) AS _ingested_at""",
        "_ingested_at DESC, s_suppkey DESC",
    ),
    "stg_stops": BASE + "SELECT * FROM stops",
    "stg_trips": _TRIP_VERSIONS,
    "stg_stop_times": BASE + "SELECT * FROM stop_times",
    "stg_calendar": """SELECT CAST(o_orderkey AS VARCHAR) AS service_id,
         CAST(dayofweek(o_orderdate) = 1 AS INTEGER) AS monday,
         CAST(dayofweek(o_orderdate) = 2 AS INTEGER) AS tuesday,
         CAST(dayofweek(o_orderdate) = 3 AS INTEGER) AS wednesday,
         CAST(dayofweek(o_orderdate) = 4 AS INTEGER) AS thursday,
         CAST(dayofweek(o_orderdate) = 5 AS INTEGER) AS friday,
         CAST(dayofweek(o_orderdate) = 6 AS INTEGER) AS saturday,
         CAST(dayofweek(o_orderdate) = 0 AS INTEGER) AS sunday,
         strftime(o_orderdate, '%Y%m%d') AS start_date, strftime(o_orderdate, '%Y%m%d') AS end_date
       FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) = 1""",
    "trip_stop_performance": BASE
    + """SELECT f.trip_id, route_id, f.stop_id, f.stop_sequence, service_date, schedule_relationship,
         CAST(delay AS DOUBLE) AS arrival_delay_seconds, CAST(delay AS DOUBLE) AS departure_delay_seconds,
         st.arrival_time AS scheduled_arrival_time_of_day,
         st.departure_time AS scheduled_departure_time_of_day, trip_headsign, service_id,
         is_orphan_trip, is_delay_outlier, f.stop_id = st.stop_id AS schedule_stop_matches,
         feed_timestamp, f._ingested_at
       FROM fact f LEFT JOIN stop_times st
         ON f.trip_id = st.trip_id AND f.stop_sequence = st.stop_sequence""",
    "silver_summary": BASE
    + """SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_orphan_trip) AS orphan_rows,
         count(*) FILTER (WHERE is_delay_outlier) AS outlier_rows,
         round(CAST(sum(delay) AS DOUBLE) / count(delay), 1) AS avg_arrival_delay_seconds,
         CAST(min(delay) AS DOUBLE) AS min_arrival_delay_seconds,
         CAST(max(delay) AS DOUBLE) AS max_arrival_delay_seconds FROM fact""",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(d AS DATE) AS VARCHAR) AS full_date,
         dayname(d) AS day_of_week, dayofweek(d) NOT IN (0, 6) AS is_weekday
       FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE),
                    CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d FROM orders)""",
    "dim_route": BASE + "SELECT * FROM routes",
    "dim_stop": BASE + "SELECT stop_id, stop_name, stop_lat, stop_lon FROM stops",
    "dim_trip": f"""SELECT trip_id, trip_headsign AS headsign, service_id,
         _feed_version AS static_feed_version FROM ({_TRIP_VERSIONS})""",
    "fact_trip_stop_performance": BASE
    + """SELECT date_key, service_date, stop_id, trip_id, stop_sequence, schedule_relationship,
         CAST(delay AS DOUBLE) AS arrival_delay_seconds, CAST(delay AS DOUBLE) AS departure_delay_seconds,
         is_late, is_cancelled, is_orphan_trip, is_delay_outlier, feed_timestamp, _ingested_at
       FROM fact""",
    "fact_service_alerts": BASE + "SELECT DISTINCT * FROM alerts",
    "route_daily_performance": BASE + "SELECT * FROM route_day",
    "stop_daily_performance": BASE
    + """SELECT date_key, s.stop_id, stop_name, count(*) AS trip_stop_count,
         count(*) FILTER (WHERE is_late) AS late_count,
         count(*) FILTER (WHERE is_cancelled) AS cancelled_count,
         round(CAST(count(*) FILTER (WHERE NOT is_late) AS DOUBLE) * 100.0::DOUBLE / count(*), 1)
           AS pct_on_time,
         round(CAST(sum(delay) AS DOUBLE) / count(delay), 1) AS avg_arrival_delay_seconds
       FROM matched f JOIN stops s ON f.stop_id = s.stop_id GROUP BY date_key, s.stop_id, stop_name""",
    "line_delay_concentration": BASE + "SELECT * FROM concentration",
    "alert_delay_impact": BASE + "SELECT * FROM impact",
    "delay_around_alerts": BASE
    + " UNION ALL ".join(
        [
            _around(
                "before",
                "f.feed_timestamp >= active_period_start - INTERVAL 2 HOUR"
                " AND f.feed_timestamp < active_period_start",
            ),
            _around("during", "f.feed_timestamp BETWEEN active_period_start AND active_period_end"),
            _around(
                "after",
                "f.feed_timestamp > active_period_end"
                " AND f.feed_timestamp <= active_period_end + INTERVAL 2 HOUR",
            ),
        ]
    ),
    "coverage_by_day": BASE
    + """SELECT service_date, count(*) FILTER (WHERE NOT is_orphan_trip) AS matched,
         count(*) FILTER (WHERE is_orphan_trip) AS orphan FROM fact GROUP BY service_date""",
    "pareto_table": BASE
    + """SELECT route_short_name, total_delay_minutes, cumulative_pct_of_network_delay
       FROM concentration""",
    "top_concentration": BASE
    + """SELECT count(*) AS lines, max(cumulative_pct_of_network_delay) AS pct_of_network_delay
       FROM (SELECT * FROM concentration ORDER BY total_delay_seconds DESC, route_short_name LIMIT 4)""",
    "on_time_by_line": BASE
    + f"""SELECT route_short_name, {_PUNCTUALITY} FROM scored
       GROUP BY route_short_name HAVING count(*) >= 50""",
    "on_time_by_hour": BASE
    + f"""SELECT CAST(hour({_LOCAL}) AS INTEGER) AS hour, {_PUNCTUALITY} FROM scored
       GROUP BY 1 HAVING count(*) >= 50""",
    "day_hour_heatmap": BASE
    + f"""SELECT CAST(dayofweek({_LOCAL}) + 1 AS INTEGER) AS day_of_week,
         CAST(hour({_LOCAL}) AS INTEGER) AS hour, {_PUNCTUALITY} FROM scored GROUP BY 1, 2""",
    "network_headline": BASE
    + """SELECT count(*) AS stops_scored,
         round(CAST(count(*) FILTER (WHERE NOT is_late) AS DOUBLE) * 100.0::DOUBLE / count(*), 1)
           AS pct_on_time,
         CAST(sum(delay) AS DOUBLE) / count(delay) / 60.0::DOUBLE AS avg_delay_minutes
       FROM scored WHERE mode = 'train'""",
    "worst_route_days": BASE
    + "SELECT * FROM route_day ORDER BY pct_on_time, date_key, route_id LIMIT 10",
    "biggest_alert_lifts": BASE
    + """SELECT * FROM impact
       ORDER BY delay_lift_seconds DESC NULLS LAST, route_id, header_text, cause, effect LIMIT 10""",
    "stop_ranking": BASE + "SELECT * FROM ranking",
    "worst_stops": BASE + "SELECT * FROM ranking ORDER BY pct_on_time, stop_id LIMIT 10",
    "delay_kpis": BASE
    + """SELECT count(*) FILTER (WHERE NOT is_orphan_trip) AS trip_stop_count,
         round(CAST(count(*) FILTER (WHERE NOT is_orphan_trip AND NOT is_late) AS DOUBLE) * 100.0::DOUBLE
               / count(*) FILTER (WHERE NOT is_orphan_trip), 1) AS pct_on_time,
         round(CAST(sum(delay) FILTER (WHERE NOT is_orphan_trip) AS DOUBLE)
               / count(delay) FILTER (WHERE NOT is_orphan_trip), 1) AS avg_delay_seconds,
         quantile_cont(CAST(delay AS DOUBLE), 0.5) FILTER (WHERE NOT is_orphan_trip)
           AS median_delay_seconds,
         round(CAST(count(*) FILTER (WHERE NOT is_orphan_trip AND is_cancelled) AS DOUBLE)
               * 100.0::DOUBLE / count(*) FILTER (WHERE NOT is_orphan_trip), 2) AS pct_cancelled,
         round(CAST(count(*) FILTER (WHERE is_orphan_trip) AS DOUBLE) * 100.0::DOUBLE / count(*), 2)
           AS pct_orphan
       FROM fact""",
    "alerts_by_cause": BASE
    + "SELECT cause, count(DISTINCT alert_id) AS alert_count FROM alerts GROUP BY cause",
    "risk_training_set": BASE + "SELECT * FROM features",
    "risk_training_set_recent": BASE
    + """, seen AS (
         SELECT DISTINCT f.route_id, f.feed_timestamp, f.trip_id, f.stop_id, f.service_date
         FROM fact f JOIN routes r ON f.route_id = r.route_id WHERE NOT f.is_orphan_trip AND f.is_late IS NOT NULL
       ), points AS (
         SELECT route_id, feed_timestamp, count(delay) AS c, sum(delay) AS s FROM matched GROUP BY ALL
       ), looks AS (
         SELECT a.route_id, a.feed_timestamp, sum(b.c) AS c, sum(b.s) AS s
         FROM points a JOIN points b ON a.route_id = b.route_id AND b.feed_timestamp < a.feed_timestamp
           AND b.feed_timestamp >= a.feed_timestamp - INTERVAL 1 HOUR GROUP BY ALL
       )
       SELECT x.*, CAST(coalesce(c, 0) AS BIGINT) AS recent_observations,
         coalesce(CAST(s AS DOUBLE) / nullif(c, 0), 0) AS recent_avg_delay_seconds
       FROM features x JOIN seen USING (trip_id, stop_id, service_date, feed_timestamp)
         LEFT JOIN looks l ON seen.route_id = l.route_id AND seen.feed_timestamp = l.feed_timestamp""",
    "risk_score_table": BASE
    + """SELECT service_date, is_late, count(*) AS n, count(*) AS chances, CAST(1 AS BIGINT) AS models
       FROM features GROUP BY service_date, is_late""",
    "risk_recent_delay": BASE
    + """, points AS (
         SELECT route_id, feed_timestamp, count(delay) AS c, sum(delay) AS s FROM matched GROUP BY ALL
       )
       SELECT route_id, feed_timestamp, CAST(recent AS BIGINT) AS recent_observations,
         CAST(total AS DOUBLE) / nullif(recent, 0) AS recent_avg_delay_seconds
       FROM (SELECT route_id, feed_timestamp, sum(c) OVER w AS recent, sum(s) OVER w AS total,
                    count(*) OVER w AS seen
             FROM points WINDOW w AS (PARTITION BY route_id ORDER BY feed_timestamp
               RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW EXCLUDE CURRENT ROW))
       WHERE seen > 0""",
    "risk_split": BASE
    + """SELECT service_date, service_date = (SELECT max(service_date) FROM features) AS is_test,
         count(*) AS n, CAST(sum(had_active_alert) AS BIGINT) AS with_alert
       FROM features GROUP BY service_date""",
    "risk_class_weights": BASE
    + """SELECT is_late, count(*) AS n,
         CAST((SELECT count(*) FROM features) AS DOUBLE)
           / ((SELECT count(DISTINCT is_late) FROM features) * count(*)) AS class_weight
       FROM features GROUP BY is_late""",
}

_RULE_NAMES = """
('stg_routes','NotNull','route_id','error'), ('stg_routes','Unique','route_id','error'),
('stg_stops','NotNull','stop_id','error'), ('stg_stops','Unique','stop_id','error'),
('stg_trips','NotNull','trip_id','error'), ('stg_trips','Unique','trip_id','error'),
('stg_trips','Relationship','route_id','error'),
('stg_stop_times','Unique','trip_id,stop_sequence','error'),
('stg_trip_updates','NotNull','entity_id','error'), ('stg_trip_updates','NotNull','trip_id','error'),
('stg_trip_updates','AcceptedValues','schedule_relationship','error'),
('stg_service_alerts','NotNull','alert_id','error'),
('stg_service_alerts','AcceptedValues','cause','error'),
('trip_stop_performance','Unique','service_date,trip_id,stop_id,stop_sequence','error'),
('dim_date','NotNull','date_key','error'), ('dim_date','Unique','date_key','error'),
('dim_route','NotNull','route_key','error'), ('dim_route','Unique','route_key','error'),
('dim_route','AcceptedValues','mode','error'),
('dim_stop','NotNull','stop_key','error'), ('dim_stop','Unique','stop_key','error'),
('fact_trip_stop_performance','Relationship','route_key','warn'),
('fact_trip_stop_performance','Unique','service_date,trip_id,stop_id,stop_sequence','error'),
('fact_service_alerts','NotNull','alert_id','error'),
('fact_service_alerts','Relationship','route_key','warn'),
('mart_route_daily_performance','AcceptedRange','pct_on_time','error'),
('mart_route_daily_performance','Unique','date_key,route_id','error'),
('mart_line_delay_concentration','AcceptedRange','cumulative_pct_of_network_delay','error')
"""

_EVENT_PATH = """'gtfs_rt_trip_updates/' || event_type || '/dt=' || strftime(ts, '%Y-%m-%d') || '/'
  || strftime(ts, '%Y%m%dT%H%M%SZ') || '.parquet'"""

_FACT_COLUMNS = """date_key, service_date, stop_id, trip_id, stop_sequence, schedule_relationship,
  CAST(delay AS DOUBLE) AS arrival_delay_seconds, CAST(delay AS DOUBLE) AS departure_delay_seconds,
  is_late, is_cancelled, is_orphan_trip, is_delay_outlier, feed_timestamp, _ingested_at"""

_PER_DAY = """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS n, CAST(sum(delay) AS BIGINT) AS delay
  FROM (SELECT feed_timestamp AS ts, delay FROM updates)"""

ORACLES |= {
    "flatten_updates": BASE
    + """, base AS (
         SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s,
           CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) END AS feed_timestamp,
           CASE event_type WHEN 'signup' THEN 'CANCELED' WHEN 'purchase' THEN 'ADDED'
                ELSE 'SCHEDULED' END AS relationship,
           CASE WHEN event_id % 2 = 1 THEN strftime(ts, '%Y%m%d') ELSE '' END AS start_date
         FROM ev)
       SELECT CAST(event_id AS VARCHAR) AS entity_id, CAST(user_id AS VARCHAR) AS trip_id,
         CAST(user_id % 25 AS VARCHAR) AS route_id, start_date, relationship AS schedule_relationship,
         event_type AS stop_id,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 ELSE 5 END AS BIGINT) AS stop_sequence,
         CAST(k AS DOUBLE) AS arrival_delay_seconds, CAST(s + k AS DOUBLE) AS arrival_time,
         CAST(NULL AS DOUBLE) AS departure_delay_seconds, CAST(NULL AS DOUBLE) AS departure_time,
         'SCHEDULED' AS stop_schedule_relationship, feed_timestamp, ts AS _ingested_at
       FROM base
       UNION ALL
       SELECT CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), CAST(user_id % 25 AS VARCHAR),
         start_date, relationship, '', 0, CASE WHEN k % 2 = 0 THEN 0 END,
         CASE WHEN k % 2 = 0 THEN CAST(s AS DOUBLE) END, CAST(k AS DOUBLE), 0, 'SKIPPED',
         feed_timestamp, ts FROM base""",
    "flatten_service_alerts": BASE
    + """, base AS (
         SELECT CAST(event_id AS VARCHAR) AS entity_id, k, event_type,
           CAST(user_id % 25 AS VARCHAR) AS route, CAST(user_id AS VARCHAR) AS trip,
           coalesce(['UNKNOWN_CAUSE','OTHER_CAUSE','TECHNICAL_PROBLEM','STRIKE','DEMONSTRATION',
             'ACCIDENT','HOLIDAY','WEATHER','MAINTENANCE','CONSTRUCTION','POLICE_ACTIVITY',
             'MEDICAL_EMERGENCY'][CASE WHEN k < 50 AND k % 14 > 0 THEN k % 14 END], 'UNKNOWN_CAUSE')
             AS cause,
           coalesce(['NO_SERVICE','REDUCED_SERVICE','SIGNIFICANT_DELAYS','DETOUR',
             'ADDITIONAL_SERVICE','MODIFIED_SERVICE','OTHER_EFFECT','UNKNOWN_EFFECT','STOP_MOVED',
             'NO_EFFECT','ACCESSIBILITY_ISSUE'][CASE WHEN k < 50 AND k % 13 > 0 THEN k % 13 END],
             'UNKNOWN_EFFECT') AS effect,
           props AS header_text, CAST(NULL AS VARCHAR) AS description_text,
           CASE WHEN k % 5 <> 0 THEN date_trunc('second', ts) END AS active_period_start,
           CASE WHEN k % 5 <> 0 AND k % 3 <> 0 THEN date_trunc('second', ts) + INTERVAL 1 HOUR END
             AS active_period_end,
           ts AS _ingested_at
         FROM ev)
       SELECT entity_id, cause, effect, header_text, description_text,
         CASE WHEN k % 2 = 0 THEN route END AS route_id, CASE WHEN k % 2 = 0 THEN '' END AS stop_id,
         CAST(NULL AS VARCHAR) AS trip_id, active_period_start, active_period_end, _ingested_at
       FROM base
       UNION ALL
       SELECT entity_id, cause, effect, header_text, description_text, '', event_type, trip,
         active_period_start, active_period_end, _ingested_at FROM base WHERE k % 2 = 0""",
    "csv_scan": """SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, l_linestatus AS stop_id,
         CAST(l_linenumber AS BIGINT) AS stop_sequence, CAST(l_partkey AS VARCHAR) AS arrival_time,
         CAST(l_suppkey AS VARCHAR) AS departure_time, CAST(l_quantity AS VARCHAR) AS shape_dist,
         'A' AS _feed_version, 'a.zip' AS _source_file
       FROM lineitem""",
    "versioned_append": """SELECT l_returnflag AS _feed_version, count(*) AS n,
         CAST(sum(l_orderkey) AS BIGINT) AS trip_sum, CAST(1 AS BIGINT) AS loads
       FROM lineitem GROUP BY l_returnflag""",
    "partitioned_scan": BASE + _PER_DAY + " GROUP BY 1",
    "load_row_counts": """SELECT 'gtfs_rt_trip_updates' AS feed, count(*) AS rows, true AS agree FROM events
       UNION ALL SELECT 'gtfs_service_alerts', 2 * count(*), true FROM events""",
    "mixed_type_ingest": BASE + _PER_DAY.replace("AS n", "AS n, true AS bad_files_listed", 1) + " GROUP BY 1",
    "file_ingest": BASE + _PER_DAY + " GROUP BY 1",
    "batch_file_append": BASE + _PER_DAY + " GROUP BY 1",
    "missing_files": BASE
    + f"""SELECT DISTINCT {_EVENT_PATH} AS subpath FROM ev
       WHERE CAST(ts AS DATE) >= DATE '2024-01-18' AND {_EVENT_PATH} NOT IN
         (SELECT {_EVENT_PATH} FROM ev WHERE k < 50)""",
    "known_versions": """SELECT p_brand AS version FROM part UNION SELECT o_orderpriority FROM orders""",
    "content_versions": "SELECT page_id, left(sha256(html), 12) AS version FROM pages",
    "versions_from_names": """SELECT event_type AS version,
         '/static/' || strftime(max(ts), '%Y%m%d') || '_' || event_type || '.zip' AS path
       FROM events GROUP BY event_type""",
    "fact_upsert": BASE + f"SELECT {_FACT_COLUMNS} FROM fact",
    "fact_stream_upsert": BASE + f"SELECT {_FACT_COLUMNS} FROM fact",
    "fact_high_water_mark": BASE.replace(
        "  FROM updates\n  QUALIFY",
        """  FROM (SELECT *, max(_ingested_at) FILTER (WHERE schedule_relationship = 'CANCELED'
                         AND day(_ingested_at) <= 12) OVER () AS mark FROM updates)
  WHERE _ingested_at > mark
     OR (schedule_relationship = 'CANCELED' AND day(_ingested_at) <= 12)
  QUALIFY""",
    )
    + f"SELECT {_FACT_COLUMNS} FROM fact",
    "late_timetable": BASE
    + """SELECT service_date, is_orphan_trip AND trip_id NOT IN (
           SELECT CAST(c_custkey AS VARCHAR) FROM customer
           WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0) AS is_orphan_trip, count(*) AS n
       FROM fact GROUP BY ALL""",
    "late_timetable_after_crash": BASE
    + """SELECT service_date, is_orphan_trip AND trip_id NOT IN (
           SELECT CAST(c_custkey AS VARCHAR) FROM customer
           WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0) AS is_orphan_trip, count(*) AS n
       FROM fact GROUP BY ALL""",
    "csv_extract": BASE + "SELECT * FROM route_day",
    "full_refresh_table": BASE + f"SELECT {_FACT_COLUMNS} FROM fact",
    "rule_report": BASE
    + f""", found(t, rule, columns, severity, failures) AS (
         SELECT *, 0 FROM (VALUES {_RULE_NAMES})
         UNION ALL SELECT 'stg_routes', 'AcceptedValues', 'route_type', 'warn',
           (SELECT count(*) FROM nation WHERE n_regionkey NOT IN (0, 2, 3, 4))
         UNION ALL SELECT 'stg_stop_times', 'Relationship', 'trip_id', 'error',
           (SELECT count(*) FROM stop_times WHERE trip_id NOT IN (SELECT trip_id FROM trips))
         UNION ALL SELECT 'fact_trip_stop_performance', 'AcceptedRange', 'arrival_delay_seconds',
           'error', (SELECT count(*) FROM fact WHERE delay < -600 OR delay > 100000)
       )
       SELECT t AS "table", rule, columns, severity, CAST(failures AS BIGINT) AS failures,
         CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
       FROM found""",
    "unmatched_trips": BASE
    + """SELECT trip_id AS value, count(*) AS rows FROM updates
       WHERE trip_id NOT IN (SELECT trip_id FROM trips) GROUP BY trip_id""",
    "source_freshness": BASE
    + """SELECT source, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(newest)) / 60000000.0::DOUBLE
           AS age_minutes, 'error' AS status
       FROM (SELECT 'gtfs_rt_trip_updates' AS source, max(ts) AS newest FROM events
             UNION ALL SELECT 'gtfs_service_alerts', max(ts) + INTERVAL 15 MINUTE FROM events)""",
    "pipeline_health": BASE
    + """SELECT 'stale' AS problem, CAST(NULL AS VARCHAR) AS service_date,
         (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(_ingested_at)))
           / 60000000.0::DOUBLE / 60.0::DOUBLE AS value FROM fact
       HAVING value > 3
       UNION ALL
       SELECT 'orphans', service_date,
         CAST(count(*) FILTER (WHERE is_orphan_trip) AS DOUBLE) * 100.0::DOUBLE / count(*) AS pct
       FROM fact WHERE service_date = (SELECT max(service_date) FROM fact)
       GROUP BY service_date HAVING pct > 5""",
    "row_counts": BASE
    + """SELECT 'gtfs_rt_trip_updates' AS "table", count(*) AS rows FROM updates
       UNION ALL SELECT 'gtfs_service_alerts', 2 * count(*) FROM all_alerts
       UNION ALL SELECT 'fact', count(*) FROM fact""",
    "version_aware_match": BASE
    + """, history AS (
         SELECT strftime(o_orderdate, '%Y%m') AS v, CAST(o_custkey AS VARCHAR) AS trip_id,
           o_orderpriority AS trip_headsign, o_orderstatus AS service_id
         FROM orders
         QUALIFY row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y%m'), o_custkey
           ORDER BY o_orderdate DESC, o_orderpriority, o_orderstatus) = 1
       ),
       current AS (
         SELECT d.service_date, coalesce(max(v) FILTER (WHERE v || '01' <= d.service_date), min(v)) AS v
         FROM (SELECT DISTINCT service_date FROM latest) d, (SELECT DISTINCT v FROM history)
         GROUP BY d.service_date
       )
       SELECT l.trip_id, l.stop_id, l.service_date, c.v AS _feed_version, h.trip_headsign, h.service_id,
         h.trip_id IS NULL AS is_orphan_trip
       FROM latest l JOIN current c ON l.service_date = c.service_date
       LEFT JOIN history h ON h.v = c.v AND h.trip_id = l.trip_id""",
    "sql_over_views": BASE
    + """SELECT mode, count(DISTINCT trip_id) AS trips, count(*) FILTER (WHERE is_late) AS late_stops,
         max(delay) AS worst_delay FROM scored GROUP BY mode""",
    "route_day_from_totals": BASE + "SELECT * FROM route_day",
    "alert_impact_from_totals": BASE + "SELECT * FROM impact",
}
