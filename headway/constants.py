"""Thresholds, code lists and enum names the results depend on."""

# Delay rules, in seconds.
ON_TIME_THRESHOLD_SECONDS = 300
PLAUSIBLE_DELAY_LOW_SECONDS = -600
PLAUSIBLE_DELAY_HIGH_SECONDS = 7200
ACCEPTED_DELAY_HIGH_SECONDS = 100000

# Sample-size floors and health limits.
MIN_GROUP_SIZE = 1000
MIN_STOP_OBSERVATIONS = 300
MAX_HOURS_SINCE_INGEST = 3
MAX_ORPHAN_PCT = 50.0
MIN_ROWS_FOR_ORPHAN_CHECK = 500
FRESHNESS_WARN_MINUTES = 30
FRESHNESS_ERROR_MINUTES = 90
SYNC_WINDOW_DAYS = 7

# Model evaluation.
TEST_FRACTION = 0.2
MODEL_SEED = 42

LOCAL_TIME_ZONE = "Australia/Sydney"

# Grain of the trip-stop fact.
FACT_GRAIN = ["service_date", "trip_id", "stop_id", "stop_sequence"]

# GTFS route_type -> mode; every other code is "other".
MODE_BY_ROUTE_TYPE = {0: "light_rail", 2: "train", 3: "bus", 4: "ferry"}
OTHER_MODE = "other"

# GTFS-Realtime enum names by wire code. The first entry of each is the value of an unset field.
TRIP_RELATIONSHIP = {
    0: "SCHEDULED",
    1: "ADDED",
    2: "UNSCHEDULED",
    3: "CANCELED",
    5: "REPLACEMENT",
    6: "DUPLICATED",
    7: "DELETED",
}
STOP_RELATIONSHIP = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}
ALERT_CAUSE = {
    1: "UNKNOWN_CAUSE",
    2: "OTHER_CAUSE",
    3: "TECHNICAL_PROBLEM",
    4: "STRIKE",
    5: "DEMONSTRATION",
    6: "ACCIDENT",
    7: "HOLIDAY",
    8: "WEATHER",
    9: "MAINTENANCE",
    10: "CONSTRUCTION",
    11: "POLICE_ACTIVITY",
    12: "MEDICAL_EMERGENCY",
}
ALERT_EFFECT = {
    8: "UNKNOWN_EFFECT",
    1: "NO_SERVICE",
    2: "REDUCED_SERVICE",
    3: "SIGNIFICANT_DELAYS",
    4: "DETOUR",
    5: "ADDITIONAL_SERVICE",
    6: "MODIFIED_SERVICE",
    7: "OTHER_EFFECT",
    9: "STOP_MOVED",
    10: "NO_EFFECT",
    11: "ACCESSIBILITY_ISSUE",
}

# What the quality rules accept.
ACCEPTED_ROUTE_TYPES = [0, 2, 3, 4]
ACCEPTED_TRIP_RELATIONSHIPS = [
    "SCHEDULED",
    "SKIPPED",
    "CANCELED",
    "ADDED",
    "DUPLICATED",
    "REPLACEMENT",
]
ACCEPTED_CAUSES = list(ALERT_CAUSE.values())
ACCEPTED_MODES = ["train", "bus", "ferry", "light_rail", "other"]
