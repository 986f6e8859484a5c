"""Rows that a model can't tell apart, kept once with their number, and a random forest grown from these.

Hours, weekdays, flags and lines have few values, so the distinct feature rows of a history stay as many while it grows. A
model of weighted rows learns the same from one row that counts n times as from n equal rows. Only the bootstrap of a forest
is about single rows: Spark draws how often each of them is in a tree from Poisson(rate), so a cell of n rows is in it
Poisson(n * rate) times. These numbers are drawn here, cell by cell, and become weights of trees grown one by one.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.session import materialize

#: Cells are worth it where rows are at least so many times as many.
FEWER = 32
#: Trees that are grown at the same time; most of a small one's time is starting its jobs.
AT_ONCE = 16
COUNT, DRAWS = "_rows", "_draws"


def cells(rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The distinct `keys` of `rows`, nulls included, with their number of rows as COUNT, as a stored table; None where they
    aren't FEWER times fewer than the rows."""
    found = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT)).hint("rebalance"), "cells")
    few, whole = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(COUNT), F.lit(0))).first()
    return found if few * FEWER <= whole else None


def with_draws(counted: DataFrame, keys: Sequence[str], trees: int, rate: float, replace: bool, seed: int) -> DataFrame:
    """Add DRAWS: how often a cell's rows are in each tree. They follow from the cell, not from its place."""
    marks = [c for k in keys for c in (F.col(k), F.col(k).isNull())]
    seeded = counted.select("*", F.xxhash64(F.lit(seed), *marks).alias("_seed"))
    schema = [f"`{n}` {t}" for n, t in counted.dtypes] + [f"{DRAWS} array<bigint>"]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = zip(batch.column("_seed").to_pylist(), batch.column(COUNT).to_pylist(), strict=True)
            drawn = []
            for mark, n in numbers:
                rng = np.random.default_rng(mark % 2**64)
                drawn.append(rng.poisson(n * rate, trees) if replace else rng.binomial(n, rate, trees))
            values = pa.array(np.concatenate(drawn) if drawn else np.empty(0, np.int64), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(range(0, trees * len(drawn) + 1, trees), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], DRAWS])

    return seeded.mapInArrow(draw, ", ".join(schema))


def grown_forest(drawn: DataFrame, forest: RandomForestClassifier) -> RandomForestClassificationModel:
    """The `forest` of the cells in `drawn`: features, label, the weight of one row, and DRAWS.

    Each tree is one of Spark's, over the cells that are in it, with the forest's depth, bins and number of features a
    node. `minInstancesPerNode` must be 1, as a cell counts as one instance.
    """
    if forest.getMinInstancesPerNode() > 1 or forest.getMinWeightFractionPerNode() > 0:
        raise ValueError("the rows of a cell are no instances of their own")
    label, weight, trees = forest.getLabelCol(), forest.getWeightCol(), forest.getNumTrees()
    subset = forest.getFeatureSubsetStrategy()
    if subset == "auto":
        subset = "sqrt" if trees > 1 else "all"
    classes = int(drawn.agg(F.max(label)).first()[0]) + 1
    # a tree may miss a class by chance, so it must be told how many there are
    named = F.col(label).cast("double").alias(label, metadata={"ml_attr": {"type": "nominal", "num_vals": classes}})
    single = {"numTrees": 1, "bootstrap": False, "subsamplingRate": 1.0, "featureSubsetStrategy": subset}
    seeds = random.Random(forest.getSeed())

    def grow(job: tuple[int, int]) -> RandomForestClassificationModel:
        at, seed = job
        weighted = (F.get(DRAWS, F.lit(at)) * F.col(weight)).alias(weight)
        sample = drawn.select(forest.getFeaturesCol(), named, weighted).where(F.col(weight) > 0)
        one = forest.copy()
        one._set(**single, seed=seed)
        return one.fit(sample)

    jobs = [(at, seeds.getrandbits(62)) for at in range(trees)]
    with ThreadPool(min(AT_ONCE, trees)) as pool:
        grown = pool.map(inheritable_thread_target(drawn.sparkSession)(grow), jobs, chunksize=1)

    context = drawn.sparkSession.sparkContext
    kinds = context._jvm.org.apache.spark.ml.classification
    members = context._gateway.new_array(kinds.DecisionTreeClassificationModel, trees)
    for at, tree in enumerate(grown):
        members[at] = tree._java_obj.trees()[0]
    whole = kinds.RandomForestClassificationModel(forest.uid, members, grown[0].numFeatures, classes)
    return forest._copyValues(RandomForestClassificationModel(whole))
