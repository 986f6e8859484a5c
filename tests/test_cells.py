import random

import numpy as np
import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from headway.operators import cells as C
from headway.plans import risk


def feature_rows(spark, n, day="20260916", seed=1, lines=("T1", "T2", None)):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        hour, line = rng.choice((6, 8, 17, 22)), rng.choice(lines)
        late = int(rng.random() < (0.7 if hour > 16 else 0.2) + (0.1 if line == "T1" else 0))
        data.append((f"t{i}", "s", day, line, "train", hour, rng.choice((2, 5)), rng.choice((0, 1)), late))
    return spark.createDataFrame(
        data,
        "trip_id string, stop_id string, service_date string, route_short_name string, mode string, hour_of_day int, "
        "day_of_week_num int, had_active_alert int, is_late int",
    ).withColumn("feed_timestamp", F.lit(at("2026-09-16T08:00:00")))


def test_cells_count_every_row_once(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a")] * 5 + [(1, None)] * 4 + [(None, "a")] * 3, "x int, y string")
    monkeypatch.setattr(C, "FEWER", 4)
    assert rows(C.cells(df, ["x", "y"])) == [(1, "a", 5), (1, None, 4), (None, "a", 3)]
    monkeypatch.setattr(C, "FEWER", 5)
    assert C.cells(df, ["x", "y"]) is None
    assert C.cells(df.limit(0), ["x", "y"]).collect() == []


def test_draws_of_a_cell_are_those_of_its_rows(spark):
    df = spark.createDataFrame([(1, None, 400), (None, 1, 400), (2, 2, 1)], f"x int, y int, {C.COUNT} bigint")
    got = {(r.x, r.y): r[C.DRAWS] for r in C.with_draws(df, ["x", "y"], 2000, 1.0, True, 42).collect()}
    for key, n in (((1, None), 400), ((None, 1), 400), ((2, 2), 1)):
        assert len(got[key]) == 2000
        # so many rows, each drawn with variance 1, vary as much as their number, not as its square
        assert np.mean(got[key]) == pytest.approx(n, rel=0.1) and np.var(got[key]) == pytest.approx(n, rel=0.2)
    assert got[(1, None)] != got[(None, 1)]
    again = C.with_draws(df.repartition(3), ["x", "y"], 2000, 1.0, True, 42).collect()
    assert {(r.x, r.y): r[C.DRAWS] for r in again} == got
    half = {(r.x, r.y): r[C.DRAWS] for r in C.with_draws(df, ["x", "y"], 500, 0.5, False, 42).collect()}
    assert max(half[(1, None)]) <= 400 and np.mean(half[(1, None)]) == pytest.approx(200, rel=0.1)


def learnt(spark, df, model, monkeypatch, by_cells):
    monkeypatch.setattr(C, "FEWER", 2 if by_cells else 10**9)
    counted = C.cells(df, (*risk.features(df), risk.LABEL))
    assert (counted is not None) == by_cells
    return risk.fit(df, model, counted)


def test_without_chance_the_cells_give_the_trees_of_the_rows(spark, monkeypatch):
    df = feature_rows(spark, 900)
    model = risk.random_forest(trees=3, max_depth=6)
    model.setBootstrap(False).setFeatureSubsetStrategy("all")
    one, other = (learnt(spark, df, model, monkeypatch, by).stages[-1] for by in (True, False))
    assert one.getNumTrees == 3 and one.numClasses == 2 and one.numFeatures == other.numFeatures

    def shape(forest):
        return [line.strip() for line in forest.toDebugString.splitlines() if "If" in line or "Else" in line or "Predict" in line]

    assert shape(one) == shape(other) != []


def test_forest_and_regression_of_cells_are_as_good(spark, monkeypatch):
    df, test = feature_rows(spark, 1500), feature_rows(spark, 600, "20260917", seed=2)
    for model in risk.candidates(trees=20, max_iter=100, max_depth=5).values():
        one, other = (learnt(spark, df, model, monkeypatch, by) for by in (True, False))
        pairs = [m.transform(test).select("trip_id", F.col("probability")).collect() for m in (one, other)]
        gaps = [abs(a.probability[1] - b.probability[1]) for a, b in zip(*map(sorted, pairs), strict=True)]
        assert max(gaps) < (1e-3 if "Logistic" in type(model).__name__ else 0.1)
        assert risk.roc_auc(one.transform(test)) == pytest.approx(risk.roc_auc(other.transform(test)), abs=0.02)


def test_a_tree_without_a_class(spark, monkeypatch):
    """Two late rows of 400 are in few of the bootstraps, and yet every tree knows two classes."""
    df = feature_rows(spark, 400, lines=("T1",)).withColumn("is_late", F.col("trip_id").isin("t1", "t2").cast("int"))
    model = learnt(spark, df, risk.random_forest(trees=12, max_depth=3), monkeypatch, True)
    assert model.stages[-1].getNumTrees == 12 and model.stages[-1].numClasses == 2
    assert all(len(r.probability) == 2 for r in model.transform(df.limit(3)).select("probability").collect())


def test_rows_that_are_no_instances_are_refused(spark):
    with pytest.raises(ValueError, match="instances"):
        C.grown_forest(spark.range(1), risk.random_forest(2).setMinInstancesPerNode(2))


def test_scores_by_cell_are_the_scores_of_the_rows(spark, monkeypatch):
    df = feature_rows(spark, 600).union(feature_rows(spark, 100, "20260917", seed=3, lines=("T1", "new", None)))
    monkeypatch.setattr(C, "FEWER", 2)
    asked = []
    fit_cells = risk._fit_cells
    monkeypatch.setattr(risk, "_fit_cells", lambda *a: asked.append(a) or fit_cells(*a))
    stored, selection = risk.train_and_select(df, risk.candidates(trees=5, max_iter=50, max_depth=5))
    assert len(asked) == 2 and set(selection.auc) == {"logistic_regression", "random_forest"}
    by_cells = risk.score(stored, selection)
    monkeypatch.setattr(C, "FEWER", 10**9)
    by_rows = risk.score(stored, selection)
    assert by_cells.columns == by_rows.columns
    assert rows(by_cells) == rows(by_rows) and by_cells.count() == 700


def test_cells_need_less_than_the_rows(spark, monkeypatch):
    """The forest of many equal rows reads the cells, not the rows."""
    monkeypatch.setattr(C, "FEWER", 4)
    df = feature_rows(spark, 600)
    seen = []
    grown = risk.grown_forest
    monkeypatch.setattr(risk, "grown_forest", lambda drawn, forest: seen.append(drawn.count()) or grown(drawn, forest))
    both = df.union(feature_rows(spark, 10, "20260917"))
    risk.train_and_select(both, {"random_forest": risk.random_forest(2, 3)})
    assert seen == [df.select(*risk.features(df), risk.LABEL).distinct().count()]
