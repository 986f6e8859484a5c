"""Delay risk: a late-arrival classifier trained and scored on the cluster with pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import constants as C
from headway.functions.columns import ratio
from headway.functions.shares import delay_measures
from headway.operators.cells import COUNT, DRAWS, cells, grown_forest, with_draws
from headway.operators.intervals import HOUR, flag_covered, interval_totals
from headway.session import materialize, scratch_dir

NUMERIC_FEATURES = ("hour_of_day", "day_of_week_num", "had_active_alert")
CATEGORICAL_FEATURES = ("route_short_name", "mode")
#: Columns that training_set adds where it is given the recent delays, and that models use where rows have them.
RECENT_FEATURES = ("recent_observations", "recent_avg_delay_seconds")
LABEL = "is_late"
#: The deepest trees that Spark grows.
DEEPEST = 30
_ROW_KEY = ("trip_id", "stop_id", "service_date", "feed_timestamp")


def training_set(
    fact: DataFrame,
    dim_route: DataFrame,
    alerts: DataFrame,
    *,
    tz: str | None = None,
    horizon: DataFrame | None = None,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Reconciled rows with a known delay, their time features, and whether an alert was open on the route.

    Hours are in the session zone unless `tz` is given. With `recent` (see recent_delay), RECENT_FEATURES come too: how
    many rows of the route had a known delay in the time before, and their mean delay, 0 where there were none.
    """
    labelled = fact.filter(~F.col("is_orphan_trip") & F.col("is_late").isNotNull()).select(
        "trip_id", "stop_id", "service_date", "feed_timestamp", "route_key", "is_late"
    )
    flagged = flag_covered(
        labelled,
        alerts,
        key="route_key",
        at="feed_timestamp",
        start="active_period_start",
        end="active_period_end",
        name="had_active_alert",
        horizon=horizon,
    )
    when = F.col("feed_timestamp") if tz is None else F.from_utc_timestamp("feed_timestamp", tz)
    named = flagged.join(dim_route.select("route_key", "route_short_name", "mode"), "route_key")
    lately = []
    if recent is not None:
        known = recent.select("route_key", "feed_timestamp", *RECENT_FEATURES)
        named = named.join(known, ["route_key", "feed_timestamp"], "left")
        lately = [F.coalesce(F.col(c), F.lit(0).cast(known.schema[c].dataType)).alias(c) for c in RECENT_FEATURES]
    return named.select(
        *_ROW_KEY,
        "route_short_name",
        "mode",
        F.hour(when).alias("hour_of_day"),
        F.dayofweek(when).alias("day_of_week_num"),
        F.col("had_active_alert").cast("int").alias("had_active_alert"),
        *lately,
        F.col("is_late").cast("int").alias(LABEL),
    )


def recent_delay(fact: DataFrame, *, seconds: int = HOUR) -> DataFrame:
    """Per route and report time, the mean delay of the route's rows in the `seconds` before it.

    The row's own instant is outside the window, so the feature cannot leak the label.
    """
    matched = fact.filter(~F.col("is_orphan_trip"))
    looks = (
        matched.select("route_key", "feed_timestamp")
        .distinct()
        .withColumn("_from", F.expr(f"feed_timestamp - interval {seconds} seconds"))
    )
    totals = interval_totals(
        matched,
        looks.select("route_key", "feed_timestamp", "_from", F.col("feed_timestamp").alias("_to")),
        key="route_key",
        at="feed_timestamp",
        start="_from",
        end="_to",
        group=["route_key", "feed_timestamp"],
        measures=delay_measures("arrival_delay_seconds"),
        bounds=(True, False),
    )
    return totals.select(
        "route_key",
        "feed_timestamp",
        F.col("delay_count").alias("recent_observations"),
        ratio(F.col("delay_sum"), F.col("delay_count")).alias("recent_avg_delay_seconds"),
    )


def mark_test_rows(
    rows: DataFrame, *, keys: Sequence[str] = _ROW_KEY, fraction: float = C.TEST_FRACTION
) -> DataFrame:
    """Add is_test: the latest service date, predicted from the earlier ones.

    With a single date, a fixed share of rows chosen by a hash of their key, which does not depend on
    partitioning.
    """
    dates = rows.agg(F.min("service_date").alias("lo"), F.max("service_date").alias("hi"))
    lo, hi = dates.select("lo").scalar(), dates.select("hi").scalar()
    buckets = 10
    hashed = F.xxhash64(F.lit(C.MODEL_SEED), *keys)
    sampled = F.pmod(hashed, F.lit(buckets)) < round(fraction * buckets)
    return rows.withColumn(
        "is_test", F.when(lo == hi, sampled).otherwise(F.col("service_date") == hi)
    )


def class_weights(rows: DataFrame) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = rows.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))
    total, classes = counts.agg(F.sum("n")).scalar(), counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(
        LABEL, "n", (total.cast("double") / (classes * F.col("n"))).alias("class_weight")
    )


def numeric_features(rows: DataFrame) -> tuple[str, ...]:
    return (*NUMERIC_FEATURES, *[c for c in RECENT_FEATURES if c in rows.columns])


def feature_stages(numeric: Sequence[str] = NUMERIC_FEATURES) -> list:
    """Scaled numbers and one-hot categories. An unseen category takes the indexer's last slot, which the
    encoder drops, so it becomes all zeros."""
    indexed = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    encoded = [f"{c}_vector" for c in CATEGORICAL_FEATURES]
    return [
        StringIndexer(
            inputCols=list(CATEGORICAL_FEATURES), outputCols=indexed, handleInvalid="keep"
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=list(numeric), outputCol="numeric"),
        StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["scaled", *encoded], outputCol="features"),
    ]


def logistic_regression(max_iter: int = 1000) -> LogisticRegression:
    return LogisticRegression(labelCol=LABEL, weightCol="class_weight", maxIter=max_iter)


def random_forest(trees: int = 200, max_depth: int = DEEPEST) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=LABEL,
        weightCol="class_weight",
        numTrees=trees,
        maxDepth=max_depth,
        seed=C.MODEL_SEED,
    )


def candidates(trees: int = 200, max_iter: int = 1000, max_depth: int = DEEPEST) -> dict[str, Estimator]:
    return {
        "logistic_regression": logistic_regression(max_iter),
        "random_forest": random_forest(trees, max_depth),
    }


def features(rows: DataFrame) -> tuple[str, ...]:
    return (*CATEGORICAL_FEATURES, *numeric_features(rows))


def _fit_cells(model: Estimator, counted: DataFrame, prepared: PipelineModel, weights: DataFrame) -> Model:
    """`model` fitted to distinct rows as to all the rows they stand for."""
    keys = [c for c in counted.columns if c != COUNT]
    forest = isinstance(model, RandomForestClassifier)
    if forest:
        drawing = {"rate": model.getSubsamplingRate(), "replace": model.getBootstrap(), "seed": model.getSeed()}
        counted = with_draws(counted, keys, model.getNumTrees(), **drawing)
    weighted = prepared.transform(counted.join(weights, LABEL))
    if forest:
        return grown_forest(materialize(weighted.select("features", LABEL, "class_weight", DRAWS), "drawn"), model)
    return model.fit(weighted.withColumn("class_weight", F.col("class_weight") * F.col(COUNT)))


def fit(train: DataFrame, model: Estimator, counted: DataFrame | None = None) -> PipelineModel:
    """Fit the feature stages and the model, and return the fitted pipeline as saved to the shared folder.

    With `counted`, the cells of the features and the label in `train`, the model is fitted to these.

    The saved form leaves the training summary behind, which holds on to the session and cannot be
    sent to tasks.
    """
    # Two labels, so two rows; a shuffle on the label would put all rows in two tasks.
    weights = F.broadcast(class_weights(train).select(LABEL, "class_weight"))
    path = scratch_dir(train.sparkSession, "risk-model")
    stages = feature_stages(numeric_features(train))
    if counted is None:
        fitted = Pipeline(stages=[*stages, model]).fit(train.join(weights, LABEL))
    else:
        prepared = Pipeline(stages=stages).fit(train)
        fitted = PipelineModel([*prepared.stages, _fit_cells(model, counted, prepared, weights)])
    fitted.save(path)
    return PipelineModel.load(path)


def roc_auc(scored: DataFrame) -> float:
    return BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC").evaluate(scored)


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy(LABEL, "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class."""
    label, predicted, n = F.col(LABEL), F.col("prediction").cast("int"), F.col("n")
    classes = F.array(F.lit(0), F.lit(1))
    counts = (
        confusion(scored)
        .select("*", F.explode(classes).alias("class"))
        .groupBy("class")
        .agg(
            F.sum(F.when((label == F.col("class")) & (predicted == F.col("class")), n)).alias("hit"),
            F.sum(F.when(predicted == F.col("class"), n)).alias("predicted"),
            F.sum(F.when(label == F.col("class"), n)).alias("support"),
        )
        .fillna(0)
    )
    precision = F.coalesce(ratio(F.col("hit"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(ratio(F.col("hit"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return counts.select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )


@dataclass(frozen=True)
class Selection:
    """The chosen model and what every candidate scored."""

    name: str
    model: PipelineModel
    auc: dict[str, float]


def select_best(auc: dict[str, float]) -> str:
    """Highest AUC; the forest wins a tie."""
    return max(auc, key=lambda name: (auc[name], name == "random_forest"))


def train_and_select(
    rows: DataFrame, models: dict[str, Estimator]
) -> tuple[DataFrame, Selection]:
    """Fit every candidate on the training rows of `rows` and compare them on the test rows.

    The feature rows are written once, since splitting and fitting read them many times; they are
    returned, marked, for scoring. Where many rows have the same features and label, models are fitted to these once,
    by their number.
    """
    marked = mark_test_rows(materialize(rows, "risk-features"))
    train, test = marked.filter(~F.col("is_test")), marked.filter("is_test")
    counted = cells(train, (*features(train), LABEL))
    fitted = {name: fit(train, model, counted) for name, model in models.items()}
    auc = {name: roc_auc(model.transform(test)) for name, model in fitted.items()}
    best = select_best(auc)
    return marked, Selection(best, fitted[best], auc)


def score(rows: DataFrame, selection: Selection) -> DataFrame:
    """Late probability of every row, training rows included. Rows with the same features get it from one of them where
    these are many."""
    chance = vector_to_array("probability")[1].alias("predicted_delay_risk")
    known = features(rows)
    counted = cells(rows, known)
    if counted is None:
        scored = selection.model.transform(rows).select(*rows.columns, chance)
    else:
        found = selection.model.transform(counted).select(*[F.col(c).alias(f"_of_{c}") for c in known], chance)
        found = materialize(found, "chances")
        scored = rows.join(found, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in known])
    return scored.select(
        "trip_id",
        "stop_id",
        "service_date",
        "predicted_delay_risk",
        F.col(LABEL).alias("actual_is_late"),
        F.lit(selection.name).alias("model_name"),
    )
