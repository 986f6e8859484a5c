import pytest
from conftest import alerts_df, at, one, routes_df, rows, trips_df, updates_df
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from headway.plans import risk, silver, staging, star


def make_fact(spark, items):
    snapshot = silver.latest_snapshot(updates_df(spark, *items))
    return star.fact_trip_stop(silver.match_trips(snapshot, trips_df(spark, "t1")))


def when(clock, day=16):
    return {"feed_timestamp": at(f"2026-09-{day}T{clock}")}


@pytest.fixture(scope="module")
def routes(spark):
    return star.dim_route(routes_df(spark, ("r1", "T1", 2), ("r2", "T2", 2)))


@pytest.fixture(scope="module")
def alerts(spark):
    window = {
        "active_period_start": at("2026-09-16T08:00:00"),
        "active_period_end": at("2026-09-16T09:00:00"),
    }
    later = {**window, "active_period_end": at("2026-09-16T08:30:00"), "entity_id": "a2"}
    open_ended = {**window, "active_period_end": None, "route_id": "r2"}
    return star.fact_service_alerts(
        staging.service_alerts(alerts_df(spark, window, later, open_ended))
    )


def test_training_set(spark, routes, alerts):
    fact = make_fact(
        spark,
        [
            {"stop_id": "a", "arrival_delay_seconds": 400.0, **when("08:15:00")},
            {"stop_id": "b", **when("09:00:00")},
            {"stop_id": "c", **when("09:00:01")},
            {"stop_id": "d", "route_id": "r2", **when("08:15:00")},
            {"stop_id": "e", "arrival_delay_seconds": None, **when("08:15:00")},
            {"stop_id": "f", "trip_id": "ghost", **when("08:15:00")},
            {"stop_id": "g", "route_id": "unknown", **when("08:15:00")},
        ],
    )
    got = risk.training_set(fact, routes, alerts).drop("feed_timestamp")
    assert rows(got) == [
        ("t1", "a", "20260916", "T1", "train", 8, 4, 1, 1),
        ("t1", "b", "20260916", "T1", "train", 9, 4, 1, 0),
        ("t1", "c", "20260916", "T1", "train", 9, 4, 0, 0),
        ("t1", "d", "20260916", "T2", "train", 8, 4, 0, 0),
    ]
    local = risk.training_set(fact, routes, alerts, tz="Australia/Sydney")
    assert rows(local.select("stop_id", "hour_of_day"))[0] == ("a", 18)


def test_recent_delay_looks_back_only(spark):
    fact = make_fact(
        spark,
        [
            {"stop_id": "a", "arrival_delay_seconds": 100.0, **when("08:00:00")},
            {"stop_id": "b", "arrival_delay_seconds": 300.0, **when("08:30:00")},
            {"stop_id": "c", "arrival_delay_seconds": 999.0, **when("09:00:00")},
            {"stop_id": "d", "arrival_delay_seconds": 5.0, "route_id": "r2", **when("08:30:00")},
            {"stop_id": "e", "arrival_delay_seconds": 7.0, **when("10:00:01")},
        ],
    )
    got = risk.recent_delay(fact).select(
        F.date_format("feed_timestamp", "HH:mm"), "recent_observations", "recent_avg_delay_seconds"
    )
    assert rows(got) == [("08:30", 1, 100.0), ("09:00", 2, 200.0)]


def marked(spark, dates):
    df = spark.createDataFrame(
        [(f"t{i}", "s", d, at("2026-09-16T08:00:00")) for i, d in enumerate(dates)],
        "trip_id string, stop_id string, service_date string, feed_timestamp timestamp",
    )
    return risk.mark_test_rows(df)


def test_last_date_is_the_test_set(spark):
    got = marked(spark, ["20260916", "20260917", "20260918", "20260918"])
    assert rows(got.select("service_date", "is_test")) == [
        ("20260916", False),
        ("20260917", False),
        ("20260918", True),
        ("20260918", True),
    ]


def test_a_single_date_falls_back_to_a_repeatable_share(spark):
    dates = ["20260916"] * 2000
    chosen = rows(marked(spark, dates).filter("is_test").select("trip_id"))
    assert 0.15 < len(chosen) / 2000 < 0.25
    again = marked(spark, dates).repartition(7).filter("is_test").select("trip_id")
    assert rows(again) == chosen


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "is_late int")
    got = {r.is_late: r.class_weight for r in risk.class_weights(df).collect()}
    assert got == pytest.approx({0: 10 / 18, 1: 5.0})


def test_selection_prefers_the_forest_on_a_tie():
    assert risk.select_best({"logistic_regression": 0.7, "random_forest": 0.7}) == "random_forest"
    assert risk.select_best({"logistic_regression": 0.8, "random_forest": 0.7}) == "logistic_regression"


def test_recent_delay_as_a_feature(spark, routes, alerts):
    fact = make_fact(
        spark,
        [
            {"stop_id": "a", "arrival_delay_seconds": 100.0, **when("08:00:00")},
            {"stop_id": "b", "arrival_delay_seconds": 300.0, **when("08:30:00")},
            {"stop_id": "c", "arrival_delay_seconds": 999.0, **when("09:00:00")},
            {"stop_id": "d", "arrival_delay_seconds": 5.0, "route_id": "r2", **when("08:30:00")},
        ],
    )
    got = risk.training_set(fact, routes, alerts, recent=risk.recent_delay(fact))
    assert rows(got.select("stop_id", *risk.RECENT_FEATURES)) == [
        ("a", 0, 0.0), ("b", 1, 100.0), ("c", 2, 200.0), ("d", 0, 0.0),
    ]
    assert risk.numeric_features(got) == (*risk.NUMERIC_FEATURES, *risk.RECENT_FEATURES)
    plain = risk.training_set(fact, routes, alerts)
    assert rows(got.select(plain.columns)) == rows(plain)


def test_models_see_recent_delays(spark):
    """The label depends on nothing but the recent delay, so only models that see it can tell."""
    days = [("20260916", 300), ("20260917", 100)]
    data = [
        (f"t{i}", "s", day, "T1", "train", 8, 2, 0, 5, float(i % 10), int(i % 10 >= 6)) for day, n in days for i in range(n)
    ]
    df = spark.createDataFrame(
        data,
        "trip_id string, stop_id string, service_date string, route_short_name string, mode string, hour_of_day int, "
        "day_of_week_num int, had_active_alert int, recent_observations long, recent_avg_delay_seconds double, is_late int",
    ).withColumn("feed_timestamp", F.lit(at("2026-09-16T08:00:00")))
    models = {"random_forest": risk.random_forest(5)}
    assert risk.train_and_select(df, models)[1].auc["random_forest"] > 0.99
    assert risk.train_and_select(df.drop(*risk.RECENT_FEATURES), models)[1].auc["random_forest"] == pytest.approx(0.5)


def test_auc_equals_the_share_of_ordered_pairs(spark):
    chances = [((7 * i) % 13 / 13, int(i % 5 < 2)) for i in range(40)]
    scored = spark.createDataFrame(chances, "p double, is_late int").withColumn("rawPrediction", array_to_vector(F.array(1 - F.col("p"), "p")))
    late, on_time = ([p for p, y in chances if y == label] for label in (1, 0))
    ordered = sum((a > b) + (a == b) / 2 for a in late for b in on_time) / (len(late) * len(on_time))
    assert risk.roc_auc(scored) == pytest.approx(ordered)


def feature_rows(spark, n, day, lines=("T1", "T2")):
    """Late exactly in the evening, mostly on the first line."""
    return [
        (f"t{i}", "s", day, lines[i % len(lines)], "train", i % 24, 1 + i % 7, i % 2, int(i % 24 >= 17))
        for i in range(n)
    ]


def test_train_select_and_score(spark):
    data = feature_rows(spark, 480, "20260916") + feature_rows(spark, 96, "20260917", ("T1", "new"))
    df = spark.createDataFrame(
        data,
        "trip_id string, stop_id string, service_date string, route_short_name string, mode string, "
        "hour_of_day int, day_of_week_num int, had_active_alert int, is_late int",
    ).withColumn("feed_timestamp", F.lit(at("2026-09-16T08:00:00")))
    models = risk.candidates(trees=5, max_iter=50)
    stored, selection = risk.train_and_select(df, models)
    assert selection.auc["random_forest"] > 0.95 and selection.auc["logistic_regression"] > 0.9
    scored = risk.score(stored, selection)
    assert scored.count() == len(data)
    assert scored.columns == [
        "trip_id", "stop_id", "service_date", "predicted_delay_risk", "actual_is_late", "model_name",
    ]
    spread = one(scored.agg(F.min("predicted_delay_risk"), F.max("predicted_delay_risk")))
    assert 0 <= spread[0] < spread[1] <= 1
    # A line never seen in training has no category of its own but is still scored.
    assert scored.filter("predicted_delay_risk IS NULL").isEmpty()
    encoded = selection.model.transform(stored.filter("route_short_name = 'new'"))
    assert one(encoded.select("route_short_name_vector").distinct())[0].numNonzeros() == 0


def test_class_report(spark):
    scored = spark.createDataFrame(
        [(1, 1.0)] * 2 + [(1, 0.0)] * 2 + [(0, 1.0)] + [(0, 0.0)] * 5, "is_late int, prediction double"
    )
    got = {r["class"]: tuple(r)[1:] for r in risk.class_report(scored).collect()}
    assert got[1] == pytest.approx((2 / 3, 0.5, 4 / 7, 4))
    assert got[0] == pytest.approx((5 / 7, 5 / 6, 10 / 13, 6))


def test_class_never_predicted_reports_zero(spark):
    scored = spark.createDataFrame([(0, 0.0), (1, 0.0)], "is_late int, prediction double")
    got = {r["class"]: tuple(r)[1:] for r in risk.class_report(scored).collect()}
    assert got[1] == (0.0, 0.0, 0.0, 1)
