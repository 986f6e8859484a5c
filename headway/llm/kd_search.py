"""Exact top-k by inner product with a KD-tree per shard.

Nodes split at the median of their widest dimension and keep the tight box of their rows. No row of a box can score
more than the box's bound for a query, so nodes are taken best bound first, until no bound reaches the k-th score
found. A query first searches the shard of its own row; the k-th score found there goes with it to all other shards.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import checkpointed, materialize
from headway.llm.vectors import best_of, matrix, met, shard_count, usable

LEAF = 64
SHARD_ROWS = 2048
SCALE = 1024

RESULT = "query_id long, vec_id long, score long"


def scaled(vector: Column) -> Column:
    """Components as whole numbers: floor(1024 * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


class KdTree:
    """Rows of whole numbers. Nodes are numbered from the root down, so a parent comes before its children."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF):
        self.rows = rows
        self.order = np.arange(len(rows))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        low, high, waiting = [], [], [(0, len(rows), -1, 0)]
        while waiting:
            begin, end, parent, side = waiting.pop()
            node = len(self.spans)
            if parent >= 0:
                pair = self.children[parent] or (-1, -1)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            mine = rows[self.order[begin:end]]
            low.append(mine.min(axis=0))
            high.append(mine.max(axis=0))
            self.spans.append((begin, end))
            self.children.append(None)
            spread = high[-1] - low[-1]
            if end - begin > leaf and spread.any():
                half = (end - begin) // 2
                part = np.argpartition(mine[:, spread.argmax()], half)
                self.order[begin:end] = self.order[begin:end][part]
                waiting += [(begin, begin + half, node, 0), (begin + half, end, node, 1)]
        self.low, self.high = np.array(low), np.array(high)
        self.sorted = rows[self.order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that a row of each node can score, by query and node."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, bounds: np.ndarray, ids: np.ndarray, own: int, k: int, least: float) -> list[tuple]:
        """The k best (score, id) among rows that score at least `least`, without rows of the id `own`."""
        best: list[tuple[float, int]] = []
        heap = [(-bounds[0], 0)]
        while heap and -heap[0][0] >= least:
            node = heapq.heappop(heap)[1]
            if children := self.children[node]:
                for child in children:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            begin, end = self.spans[node]
            scores = self.sorted[begin:end] @ query
            names = ids[self.order[begin:end]]
            good = np.flatnonzero((scores >= least) & (names != own))
            if len(good):
                best += zip(scores[good].tolist(), names[good].tolist(), strict=True)
                best.sort(key=lambda x: (-x[0], x[1]))
                del best[k:]
                if len(best) == k:
                    least = max(least, best[-1][0])
        return best


def exact_kind(*arrays: np.ndarray) -> type:
    """A number type in which inner products of these rows are exact."""
    most = max((int(max(x.max(), -x.min())) for x in arrays if x.size), default=0)
    total = most * most * arrays[0].shape[1]
    if total >= 1 << 63:
        raise ValueError("components are too large for scores of 64 bits")
    return np.float64 if total < 1 << 53 else np.int64


def _answer(rows: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    kinds = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    if not asked.num_rows:
        return kinds.empty_table()
    ids = rows.column("vec_id").to_numpy()
    vectors, queries = matrix(rows, "vector", np.int64), matrix(asked, "vector", np.int64)
    kind = exact_kind(vectors, queries)
    tree, queries = KdTree(vectors.astype(kind)), queries.astype(kind)
    least = asked.column("least").to_pylist()
    query_ids, vec_ids, scores = [], [], []
    for at in range(0, len(queries), 256):
        bounds = tree.bounds(queries[at : at + 256])
        for i, own in enumerate(asked.column("query_id").slice(at, 256).to_pylist()):
            start = least[at + i]
            best = tree.search(queries[at + i], bounds[i], ids, own, k, -np.inf if start is None else start)
            query_ids += [own] * len(best)
            vec_ids += [x for _, x in best]
            scores += [int(s) for s, _ in best]
    return pa.Table.from_pydict({"query_id": query_ids, "vec_id": vec_ids, "score": scores}, kinds)


def exact_top_k(table: DataFrame, k: int = 10, every: int = 100, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with vec_id divisible by `every`, the k rows with the highest
    inner product of scaled vectors, ties to the smaller vec_id; all, if there are fewer.

    Takes vec_id and embedding; other columns aren't read. Rows without a vec_id take no part, nor do vectors that are
    null, empty, or have a null or non-finite component. Vectors of different lengths don't meet. Rows that
    repeat both vec_id and vector count as one; a vec_id with several vectors is found by each, and asks with all of them for one
    list. A query doesn't meet its own vec_id. Scores beyond 64 bits raise.
    """
    rows = table.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.select("vec_id", scaled(F.col("embedding")).alias("vector"))
    rows = rows.dropDuplicates(["vec_id", "vector"])
    rows = materialize(rows.withColumn("dim", F.size("vector")), "scaled")
    asks = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(asks, 1))).first()
    shards = shard_count(n, shard_rows)
    index = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    queries = index.where(asks).withColumnRenamed("vec_id", "query_id").withColumnRenamed("shard", "home")

    def home(key, both):  # unannotated: with hints, Spark expects all of them
        own = both.filter(pa.compute.equal(pa.compute.fill_null(both.column("asks"), False), True))
        own = own.rename_columns(["query_id" if c == "vec_id" else c for c in own.column_names])
        return _answer(both, own.append_column("least", pa.nulls(len(own), pa.int64())), k)

    first = index.withColumn("asks", asks).groupBy("dim", "shard").applyInArrow(home, RESULT)
    first = checkpointed(best_of(first, k))
    reached = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    bounded = queries.join(reached, "query_id", "left")
    rest = met(index, bounded, shards, n_queries, lambda a, b: _answer(a, b, k), RESULT, skip="home")
    return best_of(first.select("query_id", "vec_id", "score").union(rest), k)
