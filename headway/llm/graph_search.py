"""Approximate nearest neighbours by cosine over a robust-pruned directed graph per shard (Vamana).

Rows enter the graph in batches. A greedy search from the middle proposes neighbours for a row; relaxed distance pruning
keeps a proposal only if no neighbour already kept is closer to it by the factor `ALPHA`, so edges go in different
directions; the reverse edges are added, and nodes with too many edges are pruned again. Queries search each shard with
a wider beam, and what they find is scored in double precision. Equal vectors are one node with the smallest ids, as many
as a result can hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import materialize
from headway.llm.vectors import best_of, matrix, met, shard_count, usable

SHARD_ROWS = 2048
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 256
#: Nodes that a beam expands at once.
EXPANDED = 4
#: How much closer a kept neighbour must be to a proposal to take its place; over 1, longer edges stay.
ALPHA = 1.2
BATCH = 256

INDEX = "dim int, shard int, node int, ids array<bigint>, vector array<double>, edges array<int>"
RESULT = "query_id long, vec_id long, score double"


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; they must not be zero."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


def levelled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that their largest component is near 1 and neither squares nor products run
    over; cosines stay what they are to the last bit."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def beam_search(
    rows: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, width: int, expanded: int = EXPANDED
) -> tuple[np.ndarray, np.ndarray]:
    """For unit queries the best nodes reached, (node, similarity) best first; -1 and -inf where there are fewer."""
    n = len(queries)
    nodes = np.full((n, width), -1, np.int32)
    near = np.full((n, width), -np.inf, np.float32)
    nodes[:, 0] = start
    near[:, 0] = queries @ rows[start]
    done = np.zeros((n, width), bool)
    seen = np.zeros((n, len(rows) + 1), bool)  # the last is for missing edges
    seen[:, start] = seen[:, -1] = True
    live = np.arange(n)
    while len(live):
        open_ = np.where(done[live] | (nodes[live] < 0), -np.inf, near[live])
        chosen = np.argsort(-open_, axis=1, kind="stable")[:, :expanded]
        real = np.isfinite(np.take_along_axis(open_, chosen, axis=1))
        more = real.any(axis=1)
        live, chosen, real = live[more], chosen[more], real[more]
        if not len(live):
            break
        taken = np.where(real, nodes[live[:, None], chosen], -1)
        done[live[:, None], chosen] |= real
        fresh = np.where(taken[:, :, None] >= 0, edges[taken], -1).reshape(len(live), -1)
        fresh.sort(axis=1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
        fresh[seen[live[:, None], fresh]] = -1
        seen[live[:, None], fresh] = True
        found = np.einsum("bkd,bd->bk", rows[fresh], queries[live])
        found[fresh < 0] = -np.inf
        all_near = np.concatenate([near[live], found], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
        near[live] = np.take_along_axis(all_near, best, axis=1)
        nodes[live] = np.take_along_axis(np.concatenate([nodes[live], fresh], axis=1), best, axis=1)
        done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros_like(fresh, bool)], axis=1), best, axis=1)
    nodes[~np.isfinite(near)] = -1
    return nodes, near


def robust_prune(rows: np.ndarray, nodes: np.ndarray, proposals: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node the proposals kept, closest first; -1 is no proposal and fills up."""
    valid = (proposals >= 0) & (proposals != nodes[:, None])
    held = rows[proposals]
    far = 2 - 2 * np.einsum("bkd,bd->bk", held, rows[nodes])
    far[~valid] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    far, proposals = np.take_along_axis(far, order, axis=1), np.take_along_axis(proposals, order, axis=1)
    held = np.take_along_axis(held, order[:, :, None], axis=1)
    between = 2 - 2 * np.matmul(held, held.transpose(0, 2, 1))
    kept = np.full((len(nodes), degree), -1, np.int32)
    size = np.zeros(len(nodes), int)
    alive = np.isfinite(far)
    alive[:, 1:] &= proposals[:, 1:] != proposals[:, :-1]
    for k in range(proposals.shape[1]):
        mine = np.flatnonzero(alive[:, k] & (size < degree))
        if len(mine):
            kept[mine, size[mine]] = proposals[mine, k]
            size[mine] += 1
            alive[mine] &= ~(alpha * alpha * between[mine, k] <= far[mine])
    return kept


def build_graph(rows: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Edges (node, neighbour; -1 for none) over unit rows, and the node to start from."""
    n = len(rows)
    start = int((rows @ rows.mean(axis=0)).argmax())
    edges = np.full((n + 1, degree), -1, np.int32)  # the last row answers for a missing node
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at, size = 1, 1
    while at < n:
        batch = order[at : at + size]
        proposed, _ = beam_search(rows, edges, start, rows[batch], beam)
        edges[batch] = robust_prune(rows, batch, np.concatenate([proposed, edges[batch]], axis=1), degree, alpha)
        _add_reverse(rows, edges, batch, degree, alpha)
        at, size = at + len(batch), min(BATCH, 2 * size)
    return edges, start


def _add_reverse(rows: np.ndarray, edges: np.ndarray, batch: np.ndarray, degree: int, alpha: float) -> None:
    source, target = np.repeat(batch, degree), edges[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    by = np.argsort(target, kind="stable")
    source, target = source[by], target[by]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    for part in range(0, len(nodes), BATCH):
        mine = slice(part, part + BATCH)
        widest = int(count[mine].max())
        new = np.full((len(nodes[mine]), widest), -1, np.int32)
        spot = np.arange(widest)[None, :] < count[mine][:, None]
        new[spot] = source[first[mine][0] : first[mine][-1] + count[mine][-1]]
        both = np.concatenate([edges[nodes[mine]], new], axis=1)
        room = (both >= 0).sum(axis=1) <= degree
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
        edges[nodes[mine][room]] = packed[room, :degree]
        if (~room).any():
            edges[nodes[mine][~room]] = robust_prune(rows, nodes[mine][~room], both[~room], degree, alpha)


def _index_shard(key, table):  # unannotated: with hints, Spark expects all of them
    vectors = matrix(table, "vector", np.float64)
    edges, start = build_graph(unit(vectors))
    # node 0 is the one to start from
    names = np.arange(len(vectors))
    names[[0, start]] = names[[start, 0]]
    place = np.append(np.argsort(names), -1)
    out = table.take(pa.array(names)).select(["dim", "shard", "ids", "vector"])
    moved = place[edges[names]].astype(np.int32)
    out = out.append_column("node", pa.array(np.arange(len(names)), pa.int32()))
    out = out.append_column("edges", pa.array(list(moved), pa.list_(pa.int32())))
    return out.select(["dim", "shard", "node", "ids", "vector", "edges"])


def _search_shard(table: pa.Table, asked: pa.Table, k: int, width: int) -> pa.Table:
    table = table.sort_by("node")
    vectors, queries = levelled(matrix(table, "vector", np.float64)), levelled(matrix(asked, "vector", np.float64))
    rows, edges = unit(vectors), matrix(table, "edges", np.int32)
    edges = np.concatenate([edges, np.full((1, edges.shape[1]), -1, np.int32)])
    lengths, ids = np.linalg.norm(vectors, axis=1), table.column("ids").to_pylist()
    own = asked.column("query_id").to_pylist()
    answers: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    for at in range(0, len(queries), BATCH):
        part = queries[at : at + BATCH]
        nodes, _ = beam_search(rows, edges, 0, unit(part), width)
        for i, query in enumerate(part):
            found = nodes[i][nodes[i] >= 0]
            scores = (vectors[found] @ query) / (lengths[found] * np.linalg.norm(query))
            best = [
                (-score, x)
                for score, node in zip(scores.tolist(), found.tolist(), strict=True)
                for x in ids[node]
                if x != own[at + i]
            ]
            best.sort()
            answers["query_id"] += [own[at + i]] * len(best[:k])
            answers["vec_id"] += [x for _, x in best[:k]]
            answers["score"] += [-score for score, _ in best[:k]]
    kinds = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    return pa.Table.from_pydict(answers, kinds)


def distinct_vectors(table: DataFrame, keep: int) -> DataFrame:
    """Each vector that takes part once, with its `keep` smallest vec_ids."""
    vector = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # one zero, not two
    rows = table.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.where(F.exists("embedding", lambda x: x != 0)).select("vec_id", vector.alias("vector"))
    rows = rows.withColumn("hash", F.xxhash64("vector"))
    turn = F.dense_rank().over(Window.partitionBy("hash", "vector").orderBy("vec_id"))
    rows = rows.withColumn("turn", turn).where(F.col("turn") <= keep)
    return rows.groupBy("hash", "vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


def graph_index(vectors: DataFrame, n: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graph of every shard, one row per distinct vector, as a written table."""
    shard = F.pmod(F.col("hash"), F.lit(shard_count(n, shard_rows))).cast("int")
    rows = vectors.select(F.size("vector").alias("dim"), shard.alias("shard"), "ids", "vector")
    return materialize(rows.groupBy("dim", "shard").applyInArrow(_index_shard, INDEX), "graph")


def nearest(
    table: DataFrame, k: int = 5, every: int = 50, shard_rows: int = SHARD_ROWS, width: int = SEARCH_BEAM
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with vec_id divisible by `every`, the k nearest rows found by cosine,
    nearest first, ties to the smaller vec_id; all candidates found, if there are fewer.

    Takes vec_id and embedding; other columns aren't read. Rows without a vec_id take no part, nor do vectors that are
    null, empty, zero, or have a null or non-finite component. Vectors of different lengths don't meet. Repeated rows
    count once; of a vec_id with several vectors each takes part, and a query doesn't meet its own vec_id. Huge and tiny
    components count as they are.
    """
    vectors = materialize(distinct_vectors(table, k + 1), "vectors")
    index = graph_index(vectors, vectors.count(), shard_rows)
    asks = table.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("given"))
    asks = asks.where((F.col("query_id") % every == 0) & usable(F.col("given")) & F.exists("given", lambda x: x != 0))
    vector = F.transform("given", lambda x: x.cast("double") + F.lit(0.0)).alias("vector")
    queries = materialize(asks.select("query_id", vector).distinct().withColumn("dim", F.size("vector")), "queries")
    shards = shard_count(vectors.count(), shard_rows)
    search = lambda rows, asked: _search_shard(rows, asked, k, width)
    found = met(index.drop("hash"), queries, shards, queries.count(), search, RESULT)
    return best_of(found.distinct(), k)
