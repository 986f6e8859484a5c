"""The data rules of the transit tables."""

from __future__ import annotations

from headway import constants as C
from headway.operators.quality import (
    WARN,
    AcceptedRange,
    AcceptedValues,
    NotNull,
    Relationship,
    Rule,
    Unique,
)


def _key(table: str, column: str) -> list[Rule]:
    return [NotNull(table, (column,)), Unique(table, (column,))]


STAGING_RULES: list[Rule] = [
    *_key("stg_routes", "route_id"),
    AcceptedValues("stg_routes", ("route_type",), WARN, values=tuple(C.ACCEPTED_ROUTE_TYPES)),
    *_key("stg_stops", "stop_id"),
    *_key("stg_trips", "trip_id"),
    Relationship("stg_trips", ("route_id",), parent="stg_routes", parent_column="route_id"),
    Relationship("stg_stop_times", ("trip_id",), parent="stg_trips", parent_column="trip_id"),
    Unique("stg_stop_times", ("trip_id", "stop_sequence")),
    NotNull("stg_trip_updates", ("entity_id",)),
    NotNull("stg_trip_updates", ("trip_id",)),
    AcceptedValues(
        "stg_trip_updates",
        ("schedule_relationship",),
        values=tuple(C.ACCEPTED_TRIP_RELATIONSHIPS),
    ),
    NotNull("stg_service_alerts", ("alert_id",)),
    AcceptedValues("stg_service_alerts", ("cause",), values=tuple(C.ACCEPTED_CAUSES)),
]

SILVER_RULES: list[Rule] = [Unique("trip_stop_performance", tuple(C.FACT_GRAIN))]

MART_RULES: list[Rule] = [
    *_key("dim_date", "date_key"),
    *_key("dim_route", "route_key"),
    AcceptedValues("dim_route", ("mode",), values=tuple(C.ACCEPTED_MODES)),
    *_key("dim_stop", "stop_key"),
    Relationship(
        "fact_trip_stop_performance",
        ("route_key",),
        WARN,
        parent="dim_route",
        parent_column="route_key",
    ),
    AcceptedRange(
        "fact_trip_stop_performance",
        ("arrival_delay_seconds",),
        low=C.PLAUSIBLE_DELAY_LOW_SECONDS,
        high=C.ACCEPTED_DELAY_HIGH_SECONDS,
    ),
    Unique("fact_trip_stop_performance", tuple(C.FACT_GRAIN)),
    NotNull("fact_service_alerts", ("alert_id",)),
    Relationship(
        "fact_service_alerts", ("route_key",), WARN, parent="dim_route", parent_column="route_key"
    ),
    AcceptedRange("mart_route_daily_performance", ("pct_on_time",), low=0, high=100),
    Unique("mart_route_daily_performance", ("date_key", "route_id")),
    # Rounding can push the last row a hair past 100.
    AcceptedRange(
        "mart_line_delay_concentration", ("cumulative_pct_of_network_delay",), low=0, high=100.1
    ),
]

ALL_RULES = [*STAGING_RULES, *SILVER_RULES, *MART_RULES]
