"""The given tables read as transit tables: every row of a source table becomes a row here."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas
from headway.operators.flatten import conform
from headway.plans import silver, staging, star

_STOP_SEQUENCE = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
_ROUTES = 25


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _chosen(key: Column, values: dict) -> Column:
    branch = F
    for k, v in values.items():
        branch = branch.when(key == k, v)
    return branch


def prop_k() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


@dataclass(frozen=True)
class Transit:
    """Lazy transit views of one directory of tables."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def bronze_updates(self) -> DataFrame:
        k = prop_k()
        delay = F.when(k >= 5, F.round((F.col("value") - 35.0) * 20.0))
        rows = self.events.select(
            _text("event_id").alias("entity_id"),
            _text("user_id").alias("trip_id"),
            _text(F.col("user_id") % _ROUTES).alias("route_id"),
            F.when(F.col("event_id") % 2 == 0, "")
            .otherwise(F.date_format("ts", "yyyyMMdd"))
            .alias("start_date"),
            F.when(F.col("event_type") == "signup", "CANCELED")
            .otherwise("SCHEDULED")
            .alias("schedule_relationship"),
            F.col("event_type").alias("stop_id"),
            _chosen(F.col("event_type"), _STOP_SEQUENCE).alias("stop_sequence"),
            delay.alias("arrival_delay_seconds"),
            F.lit(None).alias("arrival_time"),
            delay.alias("departure_delay_seconds"),
            F.lit(None).alias("departure_time"),
            F.lit("SCHEDULED").alias("stop_schedule_relationship"),
            F.col("ts").alias("feed_timestamp"),
            F.col("ts").alias("_ingested_at"),
            F.to_date("ts").alias("dt"),
        )
        return conform(rows, schemas.TRIP_UPDATES)

    @cached_property
    def bronze_alerts(self) -> DataFrame:
        """Every event is an alert, captured by two polls; those of error events are about a route, the others about a
        stop or the whole network, with a blank route or none."""
        k, kind = prop_k(), prop_k() % 4
        route = (
            F.when(F.col("event_type") == "error", _text(F.col("user_id") % _ROUTES))
            .when(F.col("event_type") == "click", F.lit(None))
            .otherwise("")
        )
        rows = (
            self.events.withColumn("minutes", F.explode(F.array(F.lit(0), F.lit(15))))
            .select(
                _text("event_id").alias("entity_id"),
                _chosen(
                    kind, {0: "MAINTENANCE", 1: "WEATHER", 2: "ACCIDENT", 3: "STRIKE"}
                ).alias("cause"),
                F.when(kind == 0, "MODIFIED_SERVICE").otherwise("DETOUR").alias("effect"),
                F.concat(F.lit("Alert "), _text(kind)).alias("header_text"),
                F.col("props").alias("description_text"),
                route.alias("route_id"),
                F.lit(None).alias("stop_id"),
                F.lit(None).alias("trip_id"),
                F.col("ts").alias("active_period_start"),
                F.when(k % 2 == 0, F.col("ts") + F.expr("interval 6 hours")).alias(
                    "active_period_end"
                ),
                (F.col("ts") + F.make_dt_interval(mins=F.col("minutes"))).alias("_ingested_at"),
                F.to_date("ts").alias("dt"),
            )
        )
        return conform(rows, schemas.SERVICE_ALERTS)

    # Nested feed messages.

    @cached_property
    def trip_messages(self) -> DataFrame:
        """Every event as one poll: a trip with two stop updates, and an entity of another kind."""
        schema = schemas.TRIP_UPDATE_MESSAGE
        seconds, k = F.unix_seconds("ts"), prop_k()
        header = F.struct(
            F.lit("2.0"), F.when(F.col("event_id") % 7 == 0, 0).otherwise(seconds)
        )
        code = _chosen(F.col("event_type"), {"signup": 3, "purchase": 1, "view": 99})
        trip = F.struct(
            _text("user_id"),
            _text(F.col("user_id") % _ROUTES),
            F.when(F.col("event_id") % 2 == 1, F.date_format("ts", "yyyyMMdd")),
            code,
        )
        first = F.struct(
            F.col("event_type"),
            _chosen(F.col("event_type"), _STOP_SEQUENCE).cast("bigint"),
            F.lit(None).cast("int"),
            F.struct(k, seconds + k),
            F.lit(None).cast("struct<delay:int,time:bigint>"),
        )
        second = F.struct(
            F.lit(None).cast("string"),
            F.lit(None).cast("bigint"),
            F.lit(1),
            F.when(k % 2 == 0, F.struct(F.lit(None).cast("int"), seconds)),
            F.struct(k, F.lit(None).cast("bigint")),
        )
        entity_type = schema["entity"].dataType
        item, update = entity_type.elementType, entity_type.elementType["trip_update"].dataType
        with_trip = F.struct(
            _text("event_id"),
            F.struct(
                trip,
                F.array(
                    *[
                        s.cast(update["stop_time_update"].dataType.elementType)
                        for s in (first, second)
                    ]
                ),
            ).cast(update),
        )
        other = F.struct(F.lit("other"), F.lit(None).cast(update))
        return self.events.select(
            header.cast(schema["header"].dataType).alias("header"),
            F.array(with_trip.cast(item), other.cast(item)).alias("entity"),
            F.col("ts").alias("_ingested_at"),
        )

    @cached_property
    def alert_messages(self) -> DataFrame:
        """Every event as one poll with one alert and one entity of another kind. Rows with an odd k name
        nothing; the others name a route and a trip at a stop."""
        schema = schemas.ALERT_MESSAGE
        item = schema["entity"].dataType.elementType
        alert_type = item["alert"].dataType
        k = prop_k()
        periods, informed = (alert_type[n].dataType for n in ("active_period", "informed_entity"))
        period = F.struct(
            F.unix_seconds("ts"), F.when(k % 3 == 0, 0).otherwise(F.unix_seconds("ts") + 3600)
        ).cast(periods.elementType)
        later = F.struct(F.lit(1).cast("bigint"), F.lit(2).cast("bigint")).cast(
            periods.elementType
        )
        route = F.struct(
            _text(F.col("user_id") % _ROUTES),
            F.lit(None).cast("string"),
            F.lit(None).cast("struct<trip_id:string>"),
        )
        at_stop = F.struct(
            F.lit(None).cast("string"), F.col("event_type"), F.struct(_text("user_id"))
        )
        text_type = alert_type["header_text"].dataType
        text = F.struct(F.array(F.struct(F.col("props"), F.lit("en")))).cast(text_type)
        alert = F.struct(
            F.when(k < 50, k % 14),
            F.when(k < 50, k % 13),
            text,
            F.lit(None).cast(text_type),
            F.when(k % 5 != 0, F.array(period, later)).otherwise(
                F.array().cast(periods)
            ),
            F.when(k % 2 == 0, F.array(*[e.cast(informed.elementType) for e in (route, at_stop)]))
            .otherwise(F.array().cast(informed)),
        ).cast(alert_type)
        named = F.struct(_text("event_id"), alert)
        other = F.struct(F.lit("other"), F.lit(None).cast(alert_type))
        return self.events.select(
            F.struct(F.lit("2.0"), F.unix_seconds("ts")).cast(schema["header"].dataType).alias(
                "header"
            ),
            F.array(named.cast(item), other.cast(item)).alias("entity"),
            F.col("ts").alias("_ingested_at"),
        )

    # Static timetable tables with their version history.

    @cached_property
    def bronze_routes(self) -> DataFrame:
        """Suppliers as captured versions of the route of their nation."""
        return self.table("supplier").select(
            _text("s_nationkey").alias("route_id"),
            F.col("s_name").alias("route_short_name"),
            F.concat(F.lit("Line "), _text("s_nationkey")).alias("route_long_name"),
            (F.col("s_suppkey") % 6).cast("int").alias("route_type"),
            F.lit("A").alias("agency_id"),
            F.lpad(_text("s_suppkey"), 8, "0").alias("_feed_version"),
            F.lit("supplier").alias("_source_file"),
            F.timestamp_seconds(F.round("s_acctbal").cast("bigint") * 60).alias("_ingested_at"),
        )

    @cached_property
    def bronze_stops(self) -> DataFrame:
        """Events as captured versions of their stop: five keys hold all rows."""
        return self.events.select(
            F.col("event_type").alias("stop_id"),
            F.concat(F.lit("Stop "), _text(prop_k())).alias("stop_name"),
            F.col("value").alias("stop_lat"),
            (-F.col("value")).alias("stop_lon"),
            F.lit(None).cast("string").alias("parent_station"),
            F.date_format("ts", "yyyyMMdd").alias("_feed_version"),
            F.lit("events").alias("_source_file"),
            F.col("ts").alias("_ingested_at"),
        )

    @cached_property
    def bronze_trips(self) -> DataFrame:
        """Orders as captured versions of their customer's trip."""
        return self.table("orders").select(
            _text("o_custkey").alias("trip_id"),
            _text(F.col("o_custkey") % _ROUTES).alias("route_id"),
            F.col("o_orderstatus").alias("service_id"),
            F.col("o_orderpriority").alias("trip_headsign"),
            F.lpad(_text("o_orderkey"), 12, "0").alias("_feed_version"),
            F.lit("orders").alias("_source_file"),
            F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
        )

    @cached_property
    def bronze_stop_times(self) -> DataFrame:
        """Line items as captured versions of an order's stop times; hours run past 24."""
        hour = F.lpad(_text(F.col("l_quantity").cast("int")), 2, "0")
        return self.table("lineitem").select(
            _text("l_orderkey").alias("trip_id"),
            F.col("l_returnflag").alias("stop_id"),
            F.col("l_linenumber").cast("bigint").alias("stop_sequence"),
            F.concat(hour, F.lit(":00:00")).alias("arrival_time"),
            F.concat(hour, F.lit(":01:00")).alias("departure_time"),
            F.concat(
                F.lpad(_text("l_partkey"), 12, "0"), F.lpad(_text("l_suppkey"), 12, "0")
            ).alias("_feed_version"),
            F.lit("lineitem").alias("_source_file"),
            F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
        )

    @cached_property
    def bronze_calendar(self) -> DataFrame:
        """Orders as one-day services."""
        day = F.date_format("o_orderdate", "yyyyMMdd")
        weekday = F.dayofweek("o_orderdate")
        names = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")
        return self.table("orders").select(
            _text("o_orderkey").alias("service_id"),
            *[(weekday == i + 1).cast("int").alias(n) for i, n in enumerate(names)],
            day.alias("start_date"),
            day.alias("end_date"),
            F.lit("1").alias("_feed_version"),
            F.lit("orders").alias("_source_file"),
            F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
        )

    # What the products join: one row per key.

    @cached_property
    def routes(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            _text("n_nationkey").alias("route_id"),
            F.nullif("n_name", F.lit("NATION_24")).alias("route_short_name"),
            F.col("n_name").alias("route_long_name"),
            F.col("n_regionkey").cast("int").alias("route_type"),
            F.col("r_name").alias("agency_id"),
        )

    @cached_property
    def trips(self) -> DataFrame:
        """Customers are timetabled trips; those of one segment under ids that no live trip has, so theirs are orphans."""
        own = _text("c_custkey")
        return (
            self.table("customer")
            .select(
                F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("x"), own)).otherwise(own).alias("trip_id"),
                _text("c_nationkey").alias("route_id"),
                F.col("c_mktsegment").alias("service_id"),
                F.col("c_name").alias("trip_headsign"),
            )
        )

    @cached_property
    def updates(self) -> DataFrame:
        return staging.trip_updates(self.bronze_updates)

    @cached_property
    def alerts(self) -> DataFrame:
        return staging.service_alerts(self.bronze_alerts)

    @cached_property
    def stops(self) -> DataFrame:
        return staging.static_table("stops", self.bronze_stops)

    @cached_property
    def stop_times(self) -> DataFrame:
        return staging.static_table("stop_times", self.bronze_stop_times)

    @cached_property
    def matched(self) -> DataFrame:
        return silver.match_trips(silver.latest_snapshot(self.updates), self.trips)

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_trip_stop(self.matched)

    @cached_property
    def fact_alerts(self) -> DataFrame:
        return star.fact_service_alerts(self.alerts)

    @cached_property
    def dim_route(self) -> DataFrame:
        return star.dim_route(self.routes)

    @cached_property
    def dim_stop(self) -> DataFrame:
        return star.dim_stop(self.stops)

    @cached_property
    def horizon(self) -> DataFrame:
        """The span of report times, from the raw column."""
        return self.events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
