"""Connected components of an edge table by alternating star contractions (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import checkpointed

#: With at most so many edges, even a hub's rows are few, and a window over each node's edges needs no join.
FEW_EDGES = 100_000
#: At most so many edges, some 300 KB, are joined up in the driver, without a job for each round.
DRIVER_EDGES = 20_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs the larger neighbours of every node on the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs every node and its smaller neighbours on the smallest of these; edges run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _few_stars(edges: DataFrame) -> DataFrame:
    """Both stars of a small table by windows: three shuffles instead of joins, which each take the driver a broadcast."""
    least = F.min("b").over(Window.partitionBy("a"))
    large = _both_ways(edges).withColumn("m", F.least("a", least)).where("b > a")
    small = large.select(F.col("b").alias("a"), F.col("m").alias("b")).withColumn("m", least)
    both = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return small.select(F.inline(both)).where("a <> b").distinct()


def contract(edges: DataFrame, count: int | None = None) -> DataFrame:
    """One round of both stars. Edges of the result still connect exactly what they connected, over smaller nodes."""
    few = count is not None and count <= FEW_EDGES
    return checkpointed(_few_stars(edges) if few else _small_star(_large_star(edges)))


def _joined_up(edges: DataFrame) -> DataFrame:
    """The stars of at most DRIVER_EDGES edges."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for edge in edges.select("a", "b").collect():
        one, other = top(edge.a), top(edge.b)
        parent[max(one, other)] = min(one, other)
    found = [(x, top(x)) for x in list(parent)]
    return checkpointed(edges.sparkSession.createDataFrame([f for f in found if f[0] != f[1]], edges.schema))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): every node of `edges` but the smallest of its component, with that smallest node.

    `edges` has numeric, non-null a and b; direction, repetitions and loops don't matter. Rounds grow with the
    logarithm of the longest path. Beyond FEW_EDGES, minima are taken before joining, so a hub's rows can be split over
    tasks. What is left once there are DRIVER_EDGES or fewer is joined up in one step.
    """
    now = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before, state = None, _state(now)
    while state != before and state[0]:
        if state[0] <= min(FEW_EDGES, DRIVER_EDGES):
            return _joined_up(now)
        now, before = contract(now, state[0]), state
        state = _state(now)
    return now
