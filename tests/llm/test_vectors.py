import math
import random

import numpy as np
import pytest

from headway.llm import graph_search
from headway.llm.graph_search import beam_search, build_graph, levelled, nearest, unit
from headway.llm.kd_search import KdTree, exact_kind, exact_top_k

NAN, INF = float("nan"), float("inf")
ODD = [
    (1000, None), (1100, []), (1200, [1.0, None]), (1300, [NAN, 1.0]), (1400, [INF, 0.0]), (None, [1.0, 2.0]),
    (1500, [1.0, 2.0, 3.0]), (1600, [1.0, 2.0, 2.5]),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS score", "2 AS dim", "3 AS hash", "4 AS rank")


def some(n, dim, seed, ties=False):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-3, 4, (n, dim)) / 4 if ties else rng.standard_normal((n, dim))
    return [(i, rows[i].astype(np.float32).tolist()) for i in range(n)]


def exact(rows, every, k, score):
    out = []
    for q, x in rows:
        if q is not None and q % every == 0:
            found = sorted(((-score(x, y), i) for i, y in rows if i is not None and i != q and len(x) == len(y)))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def product(x, y):
    return sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(x, y, strict=True))


def cosine(x, y):
    return float(np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)))


@pytest.mark.parametrize(("n", "dim", "ties", "shard"), [(300, 8, False, 64), (300, 3, True, 50), (7, 4, True, 2048)])
def test_top_k_is_exact(spark, n, dim, ties, shard):
    rows = some(n, dim, 1, ties)
    got = sorted(map(tuple, exact_top_k(table(spark, rows), k=10, every=20, shard_rows=shard).collect()))
    assert got == exact(rows, 20, 10, product)


def test_top_k_edges(spark):
    rows = [(0, [0.5, -0.25]), (100, [0.5, -0.25]), (3, [0.0, 0.0]), (4, [-0.0001, 9.0]), *ODD]
    usable = [r for r in rows if r[0] is not None and r[0] not in (1000, 1100, 1200, 1300, 1400)]
    got = exact_top_k(table(spark, rows + rows[:2]), k=10, every=100)
    assert sorted(map(tuple, got.collect())) == exact(usable, 100, 10, product)
    assert exact_top_k(table(spark, [])).collect() == []
    assert exact_top_k(table(spark, rows[:1])).collect() == []


def test_top_k_loses_no_vector_of_a_repeated_id(spark):
    rows = [(0, [1.0, 1.0]), (1, [0.125, 0.125]), (1, [5.0, 0.0]), (2, [1.0, 0.5]), (100, [2.0, 0.0]), (100, [0.0, 3.0])]
    for shard in (1, 2048):
        got = sorted(map(tuple, exact_top_k(table(spark, rows), k=10, every=100, shard_rows=shard).collect()))
        want = []
        for q in (0, 100):
            pairs = [(-product(x, y), i) for a, x in rows if a == q for i, y in rows if i != q]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(pairs)[:10])]
        assert got == sorted(want)


def test_tree_boxes_bound_their_rows():
    rows = np.random.default_rng(3).integers(-50, 50, (500, 6))
    tree, query = KdTree(rows, leaf=8), np.array([3, -2, 0, 7, 1, -9])
    bounds = tree.bounds(query[None])[0]
    for (begin, end), bound in zip(tree.spans, bounds, strict=True):
        assert (tree.sorted[begin:end] @ query).max() <= bound
    assert sorted(tree.order.tolist()) == list(range(500))


def test_number_types():
    assert exact_kind(np.array([[1000, 2]])) is np.float64
    assert exact_kind(np.array([[1 << 28, 2]])) is np.int64
    with pytest.raises(ValueError, match="64 bits"):
        exact_kind(np.array([[1 << 40, 2]]))


def test_nearest_recall(spark):
    rows = some(1500, 24, 5)
    got = {(r.query_id, r.vec_id): r.score for r in nearest(table(spark, rows), k=5, every=50, shard_rows=500).collect()}
    want = exact(rows, 50, 5, cosine)
    assert len([1 for q, _, i, _ in want if (q, i) in got]) >= 0.95 * len(want)
    by = dict(rows)
    for (q, i), score in got.items():
        assert score == pytest.approx(cosine(by[q], by[i]), abs=1e-12)


def test_nearest_small_and_odd(spark):
    copies = [(i, [0.3, 0.4]) for i in range(20, 40)]
    rows = [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (7, [0.0, 0.0]), (100, [0.3, 0.4]), *copies, *ODD]
    usable = [r for r in rows if r[0] is not None and r[0] not in (7, 1000, 1100, 1200, 1300, 1400)]
    got = sorted(map(tuple, nearest(table(spark, rows + copies[:3]), k=5, every=50).collect()))
    want = exact(usable, 50, 5, cosine)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    assert nearest(table(spark, [])).collect() == []
    assert nearest(table(spark, rows[:1])).collect() == []


def test_graph_reaches_everything_nearby():
    rows = unit(np.random.default_rng(1).standard_normal((700, 16)))
    rows[100:200] = unit(rows[100] + 1e-4 * np.random.default_rng(2).standard_normal((100, 16)))  # a dense spot
    edges, start = build_graph(rows)
    assert edges.shape[1] == graph_search.DEGREE and edges[-1].max() == -1
    nodes, near = beam_search(rows, edges, start, rows, 64)
    assert (nodes[:, 0] == np.arange(700)).mean() > 0.97 or (near[:, 0] > 0.9999).mean() > 0.99
    assert all(len(set(x[x >= 0])) == (x >= 0).sum() for x in nodes)


def test_graph_of_one_and_two():
    for n in (1, 2):
        rows = unit(np.eye(3)[:n])
        edges, start = build_graph(rows)
        nodes, _ = beam_search(rows, edges, start, rows, 8)
        assert {x for x in nodes[0] if x >= 0} == set(range(n))


def test_search_result_is_one_list_a_query(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice((0.5, 1.0)) for _ in range(3)]) for i in range(200)]
    got = nearest(table(spark, rows), k=5, every=50).collect()
    assert sorted((r.query_id, r.rank) for r in got) == [(q, r) for q in (0, 50, 100, 150) for r in range(1, 6)]


def test_huge_and_tiny_components_have_their_cosine(spark):
    rows = [(0, [1e200, 2e200]), (1, [1e-200, 2e-200]), (2, [2.0, 1.0]), (3, [-1e300, 1e300]), (4, [5e-324, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r.vec_id, r.score) for r in sorted(nearest(docs, k=5, every=50).collect(), key=lambda r: r.rank)]
    assert [x for x, _ in got] == [1, 2, 4, 3]
    assert [round(score, 9) for _, score in got] == [1.0, 0.8, round(5**-0.5, 9), round(10**-0.5, 9)]


def test_levelling_changes_no_bit_of_a_cosine():
    rows = np.random.default_rng(8).standard_normal((300, 16)) * 37
    flat = levelled(rows)
    cosines = lambda x: (x @ x[0]) / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[0]))
    assert (cosines(rows) == cosines(flat)).all()
