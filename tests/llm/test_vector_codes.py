import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from headway.llm.vector_codes import Tree, compressed, nearest_entries, sums_by_entry

NAN, INF = float("nan"), float("inf")


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Rows of (vec_id, vector, label), of one length, all taking part."""
    rows = [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows]
    width = len(rows[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    firsts = {}
    for i, v, _ in rows:
        if i is not None:
            firsts[i] = min(firsts.get(i, v), v)
    seeds = [firsts[i] for i in sorted(firsts)[:entries]]
    books = [[cut(v, p) for v in seeds] for p in range(parts)]
    away = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    near = lambda x, book: min(range(len(book)), key=lambda e: (away(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for _, v, _ in rows:
                held[near(cut(v, p), books[p])].append(cut(v, p))
            books[p] = [[sum(c) // len(h) for c in zip(*h, strict=True)] if h else y for h, y in zip(held, books[p], strict=True)]
    name = hashlib.sha256(",".join(str(c) for book in books for y in book for c in y).encode()).hexdigest()
    out, totals = [], {}
    for i, v, label in rows:
        codes = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(away(cut(v, p), books[p][e]) for p, e in enumerate(codes))
        totals[label] = totals.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for e in codes), error, label))
    return sorted(((i, c, e, totals[label], name) for i, c, e, label in out), key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 AS id", "2 AS dim", "3 AS v", "4 AS code", "5 AS of")


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("kind", ["normal", "ties", "far"])
def test_codes_equal_plain_lloyd(spark, kind):
    rng = np.random.default_rng(4)
    values = {"normal": rng.standard_normal((400, 16)), "ties": rng.integers(-2, 3, (400, 16)) / 4096, "far": rng.standard_normal((400, 16)) * 10000}[kind]
    rows = [(i * 7 % 400, v.tolist(), [None, 1, 2][i % 3]) for i, v in enumerate(values.astype(np.float32))]
    assert result(compressed(table(spark, rows).repartition(3))[0]) == brute(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.standard_normal(8).astype(np.float32).tolist(), i % 2) for i in range(40)]
    good += [good[3], good[3], (None, [0.5] * 8, None), (3, [9.0] * 8, None)]
    odd = [(50, None, 1), (51, [], 1), (52, [1.0] * 7 + [None], 1), (53, [NAN] * 8, 1), (54, [INF] * 8, None), (55, [1.0] * 9, 1)]
    assert result(compressed(table(spark, good + odd))[0]) == brute(good)
    other = [(i, rng.standard_normal(16).astype(np.float32).tolist(), 7) for i in range(20)]
    codes, books = compressed(table(spark, good + other))
    want = [r for part in (good, other) for r in brute(part)]
    assert result(codes) == sorted(want, key=repr) and {d: b.shape for d, b in books.items()} == {8: (8, 16, 1), 16: (8, 16, 2)}


def test_few_or_no_rows(spark):
    rows = [(5, [1.0] * 8, None), (2, [0.0] * 8, None), (9, [0.4] * 8, 3)]
    assert result(compressed(table(spark, rows))[0]) == brute(rows)
    codes, books = compressed(table(spark, []))
    assert codes.collect() == [] and books == {}
    assert codes.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_too_large_components_are_named(spark):
    with pytest.raises(PySparkException, match="vector 77"):
        compressed(table(spark, [(77, [1e30] * 8, 1)]))[0].collect()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 300), st.integers(1, 20), st.integers(1, 4), st.sampled_from([2, 50, 5000]), st.integers(0, 99))
def test_tree_assignment_is_exact(n, k, width, spread, seed):
    rng = np.random.default_rng(seed)
    rows, entries = rng.integers(-spread, spread, (n, width)), rng.integers(-spread, spread, (k, width))
    away = ((rows[:, None] - entries[None]) ** 2).sum(axis=-1)
    tree = Tree.over(rows, leaf=4)
    found, error = nearest_entries(tree, entries)
    assert (found == away.argmin(axis=1)).all() and (error == away.min(axis=1)).all()
    sums, counts = sums_by_entry(tree, entries)
    assert counts.tolist() == np.bincount(found, minlength=k).tolist()
    assert all((sums[e] == rows[found == e].sum(axis=0)).all() for e in range(k))


def test_nodes_are_assigned_whole():
    """Clustered parts never come to be compared one by one."""
    from headway.llm import vector_codes

    rng = np.random.default_rng(1)
    centres = rng.integers(-(10**6), 10**6, (16, 4))
    rows = centres[np.repeat(np.arange(16), 256)] + rng.integers(-9, 9, (4096, 4))
    compared = []
    vector_codes.assign(Tree.over(rows), centres, lambda *_: None, lambda places, _: compared.append(len(places)))
    assert sum(compared) < 200
