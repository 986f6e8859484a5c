"""Sources, sinks, incremental loads, flattening and data rules, each over whole tables.

Queries that write use fresh scratch folders and return what a reader of the written table sees.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.adapt import Transit
from checks.registry import query, wall_clock
from headway import jobs, schemas
from headway.operators import quality
from headway.operators.flatten import flatten_alerts, flatten_trip_updates
from headway.plans import marts, rules, silver, staging, star
from headway.session import materialize, scratch_dir
from headway.sinks import tables
from headway.sinks.upsert import HIGH_WATER_MARK, UpsertTable, refreshed_orphans
from headway.sources import manifest, realtime, static
from headway.streaming import ingest

NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


@query
def flatten_updates(t: Transit) -> DataFrame:
    return wall_clock(flatten_trip_updates(t.trip_messages))


@query
def flatten_service_alerts(t: Transit) -> DataFrame:
    return wall_clock(flatten_alerts(t.alert_messages))


# Timetable files.


def _stop_time_rows(t: Transit) -> DataFrame:
    """Line items as timetable rows, one timetable version per return flag."""
    return t.table("lineitem").select(
        F.col("l_orderkey").alias("trip_id"),
        F.col("l_linenumber").alias("stop_sequence"),
        F.col("l_linestatus").alias("stop_id"),
        F.col("l_partkey").alias("arrival_time"),
        F.col("l_suppkey").alias("departure_time"),
        F.col("l_quantity").alias("shape_dist"),
        F.col("l_returnflag").alias("version"),
    )


def _land_csv(rows: DataFrame, landing: str, version: str) -> str:
    path = f"{landing}/{version}/stop_times.txt"
    rows.drop("version").write.option("header", True).csv(path)
    return path


def _land_versions(t: Transit, landing: str, wanted: Column) -> None:
    rows = _stop_time_rows(t).filter(wanted)
    for (version,) in rows.select("version").distinct().collect():
        _land_csv(rows.filter(F.col("version") == version), landing, version)


@query
def csv_scan(t: Transit) -> DataFrame:
    path = _land_csv(_stop_time_rows(t), scratch_dir(t.spark, "landing"), "A")
    scanned = static.read_static_file(t.spark, path, "stop_times", "A", "a.zip")
    return scanned.drop("_ingested_at")


@query
def versioned_append(t: Transit) -> DataFrame:
    """Two versions, then a third, then nothing new."""
    landing, bronze = scratch_dir(t.spark, "landing"), scratch_dir(t.spark, "bronze")
    _land_versions(t, landing, F.col("version") != "R")
    _load_versions(t, landing, bronze)
    _land_versions(t, landing, F.col("version") == "R")
    _load_versions(t, landing, bronze)
    _load_versions(t, landing, bronze)
    loaded = static.read_static_table(t.spark, bronze, "stop_times")
    return loaded.groupBy("_feed_version").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("trip_id").cast("bigint")).alias("trip_sum"),
        F.countDistinct("_ingested_at").alias("loads"),
    )


def _load_versions(t: Transit, landing: str, bronze: str) -> None:
    # Each version folder holds the file as a Spark-written CSV folder.
    static.load_static_versions(
        t.spark, landing, bronze, "stop_times", _folder_versions(t, landing)
    )


def _folder_versions(t: Transit, landing: str) -> DataFrame:
    parts = F.split(F.col("path"), "/")
    files = manifest.list_files(t.spark, landing).filter(F.col("path").endswith(".csv"))
    return files.select(F.element_at(parts, -3).alias("version")).distinct()


# Realtime files.


def _land_updates(t: Transit, landing: str, days: Column) -> DataFrame:
    tables.append_snapshot(t.bronze_updates.filter(days).drop("dt"), landing, schemas.TRIP_UPDATES)
    return t.spark.read.schema(schemas.TRIP_UPDATES).parquet(landing)


def _early() -> Column:
    return F.dayofmonth("dt") <= 15


def _per_day(rows: DataFrame) -> DataFrame:
    days = rows.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("arrival_delay_seconds").cast("bigint")).alias("delay"),
    )
    return wall_clock(days)


@query
def partitioned_scan(t: Transit) -> DataFrame:
    landing = scratch_dir(t.spark, "landing")
    _land_updates(t, landing, F.lit(True))
    return _per_day(realtime.read_snapshots(t.spark, landing, schemas.TRIP_UPDATES))


@query
def file_ingest(t: Transit) -> DataFrame:
    """Streaming load of half the days, then the rest, then nothing new."""
    landing, bronze, log = (scratch_dir(t.spark, p) for p in ("landing", "bronze", "log"))
    for days in (_early(), ~_early(), F.lit(False)):
        _land_updates(t, landing, days)
        ingest.ingest_files(t.spark, landing, bronze, log, schemas.TRIP_UPDATES).awaitTermination()
    return _per_day(realtime.read_snapshots(t.spark, bronze, schemas.TRIP_UPDATES))


def _land_as(t: Transit, landing: str, some: Column, delay: Column) -> None:
    """Snapshots whose delays have the given type, as a writer that guesses it."""
    rows = t.bronze_updates.filter(some).withColumn("arrival_delay_seconds", delay)
    rows.write.mode("append").partitionBy("dt").parquet(landing)


@query
def load_row_counts(t: Transit) -> DataFrame:
    """Rows of two loads of each feed, as counted while they were written, and whether the tables hold as many."""
    w = jobs.Warehouse(t.spark, scratch_dir(t.spark, "warehouse"))
    landing = scratch_dir(t.spark, "landing")
    for days in (_early(), ~_early()):
        for feed, rows in (("gtfs_rt_trip_updates", t.bronze_updates), ("gtfs_service_alerts", t.bronze_alerts)):
            tables.append_snapshot(rows.filter(days).drop("dt"), f"{landing}/{feed}", jobs.FEEDS[feed][0])
        jobs.load_feeds(w, landing)
    counts = jobs.loaded_rows(w)
    stored = [w.feed(feed).select(F.lit(feed).alias("feed")) for feed in jobs.FEEDS]
    held = reduce(DataFrame.unionByName, stored).groupBy("feed").agg(F.count(F.lit(1)).alias("held"))
    return counts.join(held, "feed").select("feed", "rows", (F.col("rows") == F.col("held")).alias("agree"))


def _put(t: Transit, path: str, content: bytes) -> None:
    """Write a file that no writer of Spark's would, where Spark reads."""
    jvm, conf = t.spark._jvm, t.spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(conf).create(place)
    out.write(bytearray(content))
    out.close()


@query
def mixed_type_ingest(t: Transit) -> DataFrame:
    """Half the days land as doubles, whole numbers and without any type, next to files that are damaged; the rest later."""
    landing, bronze, log = (scratch_dir(t.spark, p) for p in ("landing", "bronze", "log"))
    delay = F.col("arrival_delay_seconds")
    load = lambda: ingest.ingest_files(t.spark, landing, bronze, log, schemas.TRIP_UPDATES).awaitTermination()
    _land_as(t, landing, _early() & delay.isNull(), F.lit(None).cast("string"))  # strings for double: quarantined
    load()
    _land_as(t, landing, _early() & (delay < 0), delay.cast("bigint"))
    _land_as(t, landing, _early() & (delay >= 0), delay)
    _land_as(t, landing, _early() & delay.isNull(), delay.cast("int"))
    _put(t, f"{landing}/dt=2024-01-01/damaged.parquet", b"PAR1 and nothing more")
    load()
    _land_as(t, landing, ~_early(), delay)
    load()
    days = _per_day(realtime.read_snapshots(t.spark, bronze, schemas.TRIP_UPDATES))
    problem = F.col("problem")
    wrong, damaged = problem.startswith("arrival_delay_seconds: string"), problem.startswith("no Parquet footer")
    bad = ingest.read_quarantine(t.spark, bronze).agg((F.count_if(wrong) > 0) & (F.count_if(damaged) == 1))
    return days.withColumn("bad_files_listed", bad.scalar())


@query
def batch_file_append(t: Transit) -> DataFrame:
    """Batch load of half the days, then the rest, then nothing new."""
    landing, bronze = scratch_dir(t.spark, "landing"), scratch_dir(t.spark, "bronze")
    for days in (_early(), ~_early(), F.lit(False)):
        _land_updates(t, landing, days)
        realtime.append_new_files(t.spark, landing, bronze, schemas.TRIP_UPDATES)
    return _per_day(realtime.read_snapshots(t.spark, bronze, schemas.TRIP_UPDATES))


# Manifests: an event is a landed file of its minute.


def _event_files(t: Transit) -> DataFrame:
    path = F.concat(
        F.lit("/landing/gtfs_rt_trip_updates/"),
        "event_type",
        F.lit("/dt="),
        F.date_format("ts", "yyyy-MM-dd"),
        F.lit("/"),
        F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"),
        F.lit(".parquet"),
    )
    return t.events.select(path.alias("path"), prop_k_is_small().alias("present"))


def prop_k_is_small() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int") < 50


@query
def missing_files(t: Transit) -> DataFrame:
    files = _event_files(t)
    return manifest.missing_files(
        files, files.filter("present"), today=dt.date(2024, 1, 25), days=7
    )


@query
def known_versions(t: Transit) -> DataFrame:
    parts = t.table("part").select(F.col("p_brand").alias("version"))
    orders = t.table("orders").select(F.col("o_orderpriority").alias("version"))
    return manifest.known_versions(parts, orders)


@query
def content_versions(t: Transit) -> DataFrame:
    pages = t.table("pages")
    return pages.select("page_id", manifest.content_version(F.col("html")).alias("version"))


@query
def versions_from_names(t: Transit) -> DataFrame:
    name = F.concat(F.lit("/static/"), F.date_format("ts", "yyyyMMdd"), F.lit("_"), "event_type")
    files = t.events.select(F.concat(name, F.lit(".zip")).alias("path"))
    return manifest.one_path_per_version(files)


# Keyed upsert.


def _fact_table(t: Transit) -> UpsertTable:
    return UpsertTable(t.spark, f"{scratch_dir(t.spark, 'gold')}/fact_trip_stop_performance")


def _fact_rows(t: Transit, updates: DataFrame) -> DataFrame:
    return star.fact_trip_stop(silver.match_trips(silver.latest_snapshot(updates), t.trips))


def _fact_output(fact: DataFrame) -> DataFrame:
    return wall_clock(fact.drop("route_key", "stop_key"))


@query
def fact_upsert(t: Transit) -> DataFrame:
    """Later rows first, then the earlier ones, then the later ones again."""
    table = _fact_table(t)
    later = F.dayofmonth("_ingested_at") > 12
    for part in (later, ~later, later):
        table.upsert(_fact_rows(t, t.updates.filter(part)))
    return _fact_output(table.read())


@query
def fact_high_water_mark(t: Transit) -> DataFrame:
    """Rows of one half, then everything: only rows newer than the first half are added."""
    table = _fact_table(t)
    first = F.col("schedule_relationship") == "CANCELED"
    for part in (first & (F.dayofmonth("_ingested_at") <= 12), F.lit(True)):
        table.upsert(_fact_rows(t, t.updates.filter(part)), mode=HIGH_WATER_MARK)
    return _fact_output(table.read())


@query
def fact_stream_upsert(t: Transit) -> DataFrame:
    landing, log = scratch_dir(t.spark, "landing"), scratch_dir(t.spark, "log")
    table = _fact_table(t)
    for days in (_early(), ~_early()):
        _land_updates(t, landing, days)
        ingest.upsert_files(
            t.spark,
            landing,
            table,
            log,
            schemas.TRIP_UPDATES,
            lambda batch: _fact_rows(t, staging.trip_updates(batch)),
        ).awaitTermination()
    return _fact_output(table.read())


@query
def late_timetable(t: Transit) -> DataFrame:
    """Orphan flags after the timetable of the remaining customers arrives."""
    newly_known = t.table("customer").filter("c_mktsegment = 'BUILDING' AND c_acctbal > 0")
    trips = newly_known.select(F.col("c_custkey").cast("string").alias("trip_id"))
    table = _fact_table(t)
    table.upsert(t.fact)
    table.upsert(refreshed_orphans(table.read(), trips))
    return table.read().groupBy("service_date", "is_orphan_trip").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def late_timetable_after_crash(t: Transit) -> DataFrame:
    """The same, if the run that loaded the timetable died before the fact was told."""
    landing, w = scratch_dir(t.spark, "landing"), jobs.Warehouse(t.spark, scratch_dir(t.spark, "warehouse"))
    newly_known = t.table("customer").filter("c_mktsegment = 'BUILDING' AND c_acctbal > 0")
    w.fact.upsert(t.fact)
    ids = newly_known.select(F.col("c_custkey").cast("string").alias("trip_id"))
    ids.write.option("header", True).csv(f"{landing}/v2/trips.txt")
    versions = ids.select(F.lit("v2").alias("version")).distinct()
    static.load_static_versions(t.spark, landing, w.bronze, "trips", versions)
    # here it died; another run finds what is left to do
    later = jobs.Warehouse(t.spark, w.root)
    static.load_static_versions(t.spark, landing, later.bronze, "trips", versions)
    jobs.apply_timetables(later)
    return later.fact.read().groupBy("service_date", "is_orphan_trip").agg(F.count(F.lit(1)).alias("n"))


# Written tables and views.


@query
def sql_over_views(t: Transit) -> DataFrame:
    """Trips, late stops and the worst delay of each mode, from the views of the fact, a dimension and the timetable."""
    jobs.views_of({"fact_trip_stop_performance": t.fact, "dim_route": t.dim_route, "stg_gtfs_static_trips": t.trips})
    return t.spark.sql(
        """
        WITH usable AS (
          SELECT * FROM fact_trip_stop_performance
          WHERE NOT (is_orphan_trip OR is_delay_outlier OR is_cancelled)
        )
        SELECT r.mode, count(DISTINCT d.trip_id) AS trips, count_if(u.is_late) AS late_stops,
               max(u.arrival_delay_seconds) AS worst_delay
        FROM usable u NATURAL JOIN (SELECT route_key, mode FROM dim_route WHERE route_short_name IS NOT NULL) r
          JOIN stg_gtfs_static_trips d ON d.trip_id = u.trip_id
        GROUP BY r.mode
        """
    )


@query
def csv_extract(t: Transit) -> DataFrame:
    daily = marts.route_daily_performance(t.fact, t.dim_route)
    root = scratch_dir(t.spark, "extracts")
    paths = tables.export_csv({"mart_route_daily_performance": daily}, root)
    written = t.spark.read.option("header", True).option("escape", '"').schema(daily.schema)
    return written.csv(paths["mart_route_daily_performance"])


@query
def full_refresh_table(t: Transit) -> DataFrame:
    """A fact written twice, partitioned by service date."""
    path = f"{scratch_dir(t.spark, 'gold')}/fact"
    for _ in range(2):
        tables.write_table(t.fact, path, ["service_date"])
    fact = t.spark.read.schema(schemas.FACT_TRIP_STOP).parquet(path)
    return _fact_output(fact.select(*schemas.FACT_TRIP_STOP.names))


def _stored_totals(t: Transit, keys: list[str]) -> DataFrame:
    path = f"{scratch_dir(t.spark, 'gold')}/totals"
    totals = marts.totals(t.fact, *keys)
    tables.replace_partitions(totals, path, "service_date")
    return t.spark.read.schema(totals.schema).parquet(path)


@query
def route_day_from_totals(t: Transit) -> DataFrame:
    return marts.route_daily_performance(_stored_totals(t, marts.DAY_TOTALS), t.dim_route)


@query
def alert_impact_from_totals(t: Transit) -> DataFrame:
    instants = _stored_totals(t, marts.INSTANT_TOTALS)
    return marts.alert_delay_impact(instants, t.dim_route, t.fact_alerts)


# Data rules.


def _rule_tables(t: Transit) -> dict[str, DataFrame]:
    """The fact as a stored table, which is what the rules check; staging as views."""
    fact = materialize(t.fact, "fact")
    daily = marts.route_daily_performance(fact, t.dim_route)
    return {
        "stg_routes": t.routes,
        "stg_stops": t.stops,
        "stg_trips": t.trips,
        "stg_stop_times": t.stop_times,
        "stg_trip_updates": t.updates,
        "stg_service_alerts": t.alerts,
        "trip_stop_performance": t.matched,
        "dim_date": star.dim_date(t.bronze_calendar),
        "dim_route": t.dim_route,
        "dim_stop": t.dim_stop,
        "fact_trip_stop_performance": fact,
        "fact_service_alerts": t.fact_alerts,
        "mart_route_daily_performance": daily,
        "mart_line_delay_concentration": marts.line_delay_concentration(fact, t.dim_route),
    }


@query
def rule_report(t: Transit) -> DataFrame:
    return quality.check_rules(_rule_tables(t), rules.ALL_RULES)


@query
def unmatched_trips(t: Transit) -> DataFrame:
    return quality.unmatched(t.updates, "trip_id", t.trips, "trip_id")


@query
def source_freshness(t: Transit) -> DataFrame:
    sources = {"gtfs_rt_trip_updates": t.updates, "gtfs_service_alerts": t.alerts}
    return quality.freshness(sources, NOW).drop("newest")


@query
def pipeline_health(t: Transit) -> DataFrame:
    return quality.pipeline_health(t.fact, NOW, min_rows=1, max_orphan_pct=5.0)


@query
def row_counts(t: Transit) -> DataFrame:
    return quality.row_counts(
        {"gtfs_rt_trip_updates": t.updates, "gtfs_service_alerts": t.alerts, "fact": t.fact}
    )
