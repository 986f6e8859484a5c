"""The jobs of one pipeline run, and a command line over them.

    python -m headway.jobs run --landing /data/landing --warehouse /data/warehouse

Landing layout:
    <landing>/gtfs_static/<version>/<table>.txt
    <landing>/gtfs_rt_trip_updates/dt=YYYY-MM-DD/*.parquet
    <landing>/gtfs_service_alerts/dt=YYYY-MM-DD/*.parquet

A step that fails raises, so nothing after it runs; every step can be run again.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas
from headway.operators import quality
from headway.operators.flatten import flatten_alerts, flatten_trip_updates
from headway.plans import findings, marts, risk, rules, silver, staging, star
from headway.session import build_session
from headway.sinks.ledger import Ledger, ensure_exists
from headway.sinks.tables import append_snapshot, export_csv, replace_partitions, write_table
from headway.sinks.upsert import LATEST_WINS, UpsertTable, refreshed_orphans
from headway.sources import realtime, static
from headway.streaming.ingest import ingest_files, read_loads, read_quarantine, upsert_files

FEEDS = {
    "gtfs_rt_trip_updates": (schemas.TRIP_UPDATES, schemas.TRIP_UPDATE_MESSAGE, flatten_trip_updates),
    "gtfs_service_alerts": (schemas.SERVICE_ALERTS, schemas.ALERT_MESSAGE, flatten_alerts),
}


TOTALS = {"day_totals": marts.DAY_TOTALS, "instant_totals": marts.INSTANT_TOTALS}
CLOCK_MARGIN = dt.timedelta(hours=1)
DIMENSIONS = ("dim_date", "dim_route", "dim_stop", "dim_trip", "fact_service_alerts")
MARTS = (
    "mart_route_daily_performance",
    "mart_stop_daily_performance",
    "mart_line_delay_concentration",
    "mart_alert_delay_impact",
)


@dataclass(frozen=True)
class Warehouse:
    """Where the tables of one warehouse are."""

    spark: SparkSession
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root.rstrip('/')}/bronze"

    def gold(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/gold/{table}"

    def checkpoint(self, job: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{job}"

    @property
    def fact(self) -> UpsertTable:
        return UpsertTable(self.spark, self.gold("fact_trip_stop_performance"))

    def static(self, table: str) -> DataFrame:
        return staging.static_table(
            table, static.read_static_table(self.spark, self.bronze, table)
        )

    def feed(self, feed: str) -> DataFrame:
        return realtime.read_snapshots(self.spark, f"{self.bronze}/{feed}", FEEDS[feed][0])

    def updates(self) -> DataFrame:
        return staging.trip_updates(self.feed("gtfs_rt_trip_updates"))

    def alerts(self) -> DataFrame:
        return staging.service_alerts(self.feed("gtfs_service_alerts"))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.gold(name))

    def totals_schema(self, name: str) -> T.StructType:
        empty = self.spark.createDataFrame([], schemas.FACT_TRIP_STOP)
        return marts.totals(empty, *TOTALS[name]).schema

    def totals(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.totals_schema(name)).parquet(self.gold(name))

    def silver(self) -> DataFrame:
        return silver.trip_stop_performance(
            self.updates(), self.static("trips"), self.static("stop_times")
        )


def create_views(w: Warehouse) -> list[str]:
    """Every table of the warehouse under its SQL name: staging and silver as views over bronze, gold as
    stored."""
    views = {f"stg_gtfs_static_{t}": w.static(t) for t in schemas.STATIC}
    views |= {
        "stg_gtfs_rt_trip_updates": w.updates(),
        "stg_gtfs_service_alerts": w.alerts(),
        "int_trip_stop_performance": w.silver(),
        "fact_trip_stop_performance": w.fact.read(),
        **{name: w.table(name) for name in (*DIMENSIONS, *MARTS)},
    }
    return views_of(views)


def views_of(tables: dict[str, DataFrame]) -> list[str]:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def land_messages(spark: SparkSession, feed: str, messages: str, landing: str) -> int:
    """Flatten nested feed messages (JSON lines) into the feed's landing folder; returns the rows added."""
    schema, nested, flatten = FEEDS[feed]
    rows = flatten(spark.read.schema(nested).json(messages))
    return append_snapshot(rows, f"{landing.rstrip('/')}/{feed}", schema)


@contextmanager
def nothing_landed_is_fine() -> Iterator[None]:
    """A feed whose folder does not exist yet has no files to load."""
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise


def load_bronze(
    w: Warehouse, landing: str, *, max_files: int | None = None
) -> dict[str, dict[str, int]]:
    """Load new timetable versions and new realtime files, `max_files` of them per micro-batch. Returns rows
    per new timetable version."""
    loaded = static.load_static(w.spark, f"{landing.rstrip('/')}/gtfs_static", w.bronze)
    load_feeds(w, landing, max_files=max_files)
    return loaded


def load_feeds(w: Warehouse, landing: str, *, max_files: int | None = None) -> None:
    """Load the realtime files that landed since the last time."""
    for feed, (schema, _, _) in FEEDS.items():
        with nothing_landed_is_fine():
            ingest_files(
                w.spark,
                f"{landing.rstrip('/')}/{feed}",
                f"{w.bronze}/{feed}",
                w.checkpoint(feed),
                schema,
                max_files=max_files,
            ).awaitTermination()


def loaded_rows(w: Warehouse) -> DataFrame:
    """(feed, loads, files, rows) over all loads so far, from what each load counted as it wrote; no table is read."""
    loads = [read_loads(w.spark, f"{w.bronze}/{feed}").withColumn("feed", F.lit(feed)) for feed in FEEDS]
    totals = [F.count(F.lit(1)).alias("loads"), F.sum("files").alias("files"), F.sum("rows").alias("rows")]
    return reduce(DataFrame.unionByName, loads).groupBy("feed").agg(*totals)


def quarantined_files(w: Warehouse) -> DataFrame:
    """(feed, path, problem) of the landed files that no load could take."""
    bad = [read_quarantine(w.spark, f"{w.bronze}/{feed}").withColumn("feed", F.lit(feed)) for feed in FEEDS]
    return reduce(DataFrame.unionByName, bad).select("feed", "path", "problem")


def update_fact(w: Warehouse, *, mode: str = LATEST_WINS, max_files: int | None = None) -> None:
    """Upsert what the new bronze files hold, then clear the orphan flags that newly loaded trips explain."""

    def to_rows(batch: DataFrame) -> DataFrame:
        snapshot = silver.latest_snapshot(staging.trip_updates(batch))
        return star.fact_trip_stop(silver.match_trips(snapshot, w.static("trips")))

    with nothing_landed_is_fine():
        upsert_files(
            w.spark,
            f"{w.bronze}/gtfs_rt_trip_updates",
            w.fact,
            w.checkpoint("fact"),
            schemas.TRIP_UPDATES,
            to_rows,
            mode=mode,
            max_files=max_files,
        ).awaitTermination()
    apply_timetables(w)


def apply_timetables(w: Warehouse) -> list[str]:
    """Clear the orphan flags explained by timetable versions that were loaded, but not applied to the fact yet.

    What is left to do is read from the records of both steps, so a run that died anywhere between them is made up for
    by the next one. Applying a version again changes nothing. Returns the versions applied.
    """
    applied = Ledger(w.spark, w.gold("_timetables_log"))
    loaded = static.loaded_versions(w.spark, w.bronze, "trips")
    versions = [r["item"] for r in loaded.join(applied.items("trips", "applied"), "item", "left_anti").collect()]
    if versions:
        trips = static.read_static_table(w.spark, w.bronze, "trips")
        new = trips.filter(F.col("_feed_version").isin(versions))
        w.fact.upsert(refreshed_orphans(w.fact.read(), new))
        applied.record("trips", versions, "applied")
    return versions


def refresh_totals(w: Warehouse) -> None:
    """Bring the stored totals of the fact up to date, for the service dates changed since the last time.

    The moment recorded is that of the start, less a margin for clocks that differ: a date may be
    done twice, never missed.
    """
    ledger = Ledger(w.spark, w.gold("_totals_log"))
    began = dt.datetime.now(dt.timezone.utc) - CLOCK_MARGIN
    last = ledger.items("totals", "done").agg(F.max("item")).first()[0]
    since = None if last is None else dt.datetime.fromisoformat(last)
    changed = w.fact.partitions_of(w.fact.changed_since(since))
    for name, keys in TOTALS.items():
        ensure_exists(w.spark, w.gold(name), w.totals_schema(name), ["service_date"])
        replace_partitions(marts.totals(changed, *keys), w.gold(name), "service_date")
    ledger.record("totals", [began.isoformat()], "done")


def build_gold(w: Warehouse) -> dict[str, int]:
    """Full refresh of dimensions, alert fact and marts. Returns the rows written per table.

    Marts over all history are built from the stored totals, so a run reads the fact rows of changed
    service dates only.
    """
    ensure_exists(w.spark, w.fact.path, w.fact.schema, [w.fact.partition])
    refresh_totals(w)
    counts = {
        name: write_table(df, w.gold(name))
        for name, df in {
            "dim_date": star.dim_date(w.static("calendar")),
            "dim_route": star.dim_route(w.static("routes")),
            "dim_stop": star.dim_stop(w.static("stops")),
            "dim_trip": star.dim_trip(w.static("trips")),
            "fact_service_alerts": star.fact_service_alerts(w.alerts()),
        }.items()
    }
    routes, stops, alerts = (w.table(n) for n in ("dim_route", "dim_stop", "fact_service_alerts"))
    days, instants = w.totals("day_totals"), w.totals("instant_totals")
    products = {
        "mart_route_daily_performance": marts.route_daily_performance(days, routes),
        "mart_stop_daily_performance": marts.stop_daily_performance(days, stops),
        "mart_line_delay_concentration": marts.line_delay_concentration(days, routes),
        "mart_alert_delay_impact": marts.alert_delay_impact(instants, routes, alerts),
    }
    return counts | {name: write_table(df, w.gold(name)) for name, df in products.items()}


def check(w: Warehouse, now=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rule report, source freshness, and health problems."""
    now = F.current_timestamp() if now is None else now
    gold = [
        "dim_date",
        "dim_route",
        "dim_stop",
        "fact_service_alerts",
        "mart_route_daily_performance",
        "mart_line_delay_concentration",
    ]
    tables = {
        **{f"stg_{t}": w.static(t) for t in ("routes", "stops", "trips", "stop_times")},
        "stg_trip_updates": w.updates(),
        "stg_service_alerts": w.alerts(),
        "trip_stop_performance": w.silver(),
        "fact_trip_stop_performance": w.fact.read(),
        **{name: w.table(name) for name in gold},
    }
    sources = {"gtfs_rt_trip_updates": w.updates(), "gtfs_service_alerts": w.alerts()}
    return (
        quality.check_rules(tables, rules.ALL_RULES),
        quality.freshness(sources, now),
        quality.pipeline_health(w.fact.read(), now),
    )


def extract(w: Warehouse, out: str) -> dict[str, str]:
    names = [
        "mart_route_daily_performance",
        "mart_line_delay_concentration",
        "mart_alert_delay_impact",
        "fact_service_alerts",
        "dim_route",
        "dim_stop",
        "dim_date",
    ]
    fact = {"fact_trip_stop_performance": w.fact.read()}
    return export_csv({**{n: w.table(n) for n in names}, **fact}, out)


def report_findings(w: Warehouse) -> dict[str, DataFrame]:
    fact, routes = w.fact.read(), w.table("dim_route")
    concentration = w.table("mart_line_delay_concentration")
    return {
        "coverage_by_day": findings.coverage_by_day(fact).orderBy("service_date"),
        "network_headline": findings.network_headline(fact, routes),
        "pareto": findings.pareto_table(concentration),
        "top_concentration": findings.top_concentration(concentration),
        "on_time_by_line": findings.on_time_by_line(fact, routes).orderBy("pct_on_time"),
        "on_time_by_hour": findings.on_time_by_hour(fact, routes).orderBy("hour"),
    }


def store_findings(w: Warehouse) -> dict[str, str]:
    """Write every finding, whole, as a table of its own; returns where."""
    paths = {name: w.gold(f"finding_{name}") for name in report_findings(w)}
    for name, df in report_findings(w).items():
        write_table(df, paths[name])
    return paths


def store_check(w: Warehouse, now=None) -> tuple[dict[str, str], bool]:
    """Evaluate the checks once and write their results. Returns where, and whether all is well: no rule failed, no source
    is stale beyond the error limit or empty, no health problem."""
    names = ("rule_report", "source_freshness", "health_problems")
    paths = {name: w.gold(f"check_{name}") for name in names}
    for path, df in zip(paths.values(), check(w, now), strict=True):
        write_table(df, path)
    report, fresh, problems = (w.spark.read.parquet(path) for path in paths.values())
    bad = report.filter("status = 'fail'").select("status").union(fresh.filter("status = 'error'").select("status"))
    return paths, bad.isEmpty() and problems.isEmpty()


def train_risk(
    w: Warehouse, *, trees: int = 200, max_iter: int = 1000, max_depth: int = risk.DEEPEST, recent: bool = False
) -> risk.Selection:
    """Train, compare and keep the best classifier, and replace the score table with its scores.

    With `recent`, the models also see the route's delay in the hour before.
    """
    fact = w.fact.read()
    rows = risk.training_set(
        fact,
        w.table("dim_route"),
        w.table("fact_service_alerts"),
        recent=risk.recent_delay(fact) if recent else None,
    )
    marked, selection = risk.train_and_select(rows, risk.candidates(trees, max_iter, max_depth))
    write_table(risk.score(marked, selection), w.gold("mart_trip_delay_risk_score"))
    return selection


def run(w: Warehouse, landing: str) -> None:
    load_bronze(w, landing)
    update_fact(w)
    build_gold(w)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="headway")
    parser.add_argument("job", choices=["run", "check", "findings", "extract", "train"])
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--landing")
    parser.add_argument("--out")
    parser.add_argument("--recent", action="store_true", help="train with the route's delay in the hour before")
    args = parser.parse_args(argv)
    w = Warehouse(build_session(), args.warehouse)
    if args.job == "run":
        run(w, args.landing)
    elif args.job == "findings":
        print(store_findings(w))
    elif args.job == "extract":
        print(extract(w, args.out))
    elif args.job == "train":
        print(train_risk(w, recent=args.recent).auc)
    else:
        paths, passed = store_check(w)
        print(paths)
        return 0 if passed else 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
