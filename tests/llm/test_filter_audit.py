import random
import re
from itertools import combinations, permutations
from math import factorial

import pytest
from llm_tables import clashing, documents  # noqa: F401

from headway.llm.filter_audit import audit, interactions, path_counts


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tests = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), re.search(r"[#$%&*|]", text))
    return {n for n, t in zip("ABCD", tests, strict=True) if t}


def brute(rows, labels):
    """Applies the filters document by document, in every order."""
    good, toxic = ({d for d, q, t in labels if d is not None and (q, t)[k] == 1} for k in (0, 1))
    docs = []
    for d, text, lang, *_ in rows:
        text = text or ""
        copy = d is not None and any(o is not None and o < d and (t or "") == text for o, t, *_ in rows)
        docs.append((d, lang or "", failed(text) | ({"E"} if copy else set())))
    out, share = [], {}
    for part in {p for _, p, _ in docs}:
        for order in permutations("ABCDE"):
            left, gone = [x for x in docs if x[1] == part], []
            for step, name in enumerate(order):
                here = [x for x in left if name in x[2]]
                redundant = sum(name in x[2] for x in gone)
                left, gone = [x for x in left if name not in x[2]], gone + here
                alone = sum(x[2] == {name} for x in docs if x[1] == part)
                share[part, name] = share.get((part, name), 0) + len(here)
                lost = [sum(x[0] in s for x in here) for s in (good, toxic)]
                out.append((part, "".join(order), step + 1, len(left), len(here), redundant, alone, *lost))
    return sorted((*r, share[r[0], r[1][r[2] - 1]]) for r in out)


def some(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        words = rng.choices(["alpha", "be", "CAPS", "x#", "Day", "o" * 30], [9, 9, rng.choice([0, 3]), rng.choice([0, 0.1]), 1, 2], k=rng.choice([0, 3, 150, 200, 260]))
        yield i, rng.choice(["copied text", None, ""]) if rng.random() < 0.2 else " ".join(w + str(rng.randrange(400)) * (rng.random() < 0.7) for w in words), rng.choice(["en", "de", None, ""]), None


def test_audit_equals_filtering_in_every_order(spark, documents, clashing):
    rows = list(some(150, 1)) + [(150, "copied text", "en", None), (150, "copied text", "en", None), (None, "copied text", "de", None), (None, None, None, None)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 150, 2)] + [(4, 1, None), (4, 0, 1), (4, 1, 1), (None, 1, 1), (9999, 1, 1), (7, None, None)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "1 AS part", "2 AS mask", "3 AS good")
    got = audit(clashing(documents(rows)).selectExpr("*", "1 AS part", "2 AS mask", "3 AS words", "4 AS digest"), table)
    assert sorted(map(tuple, got.collect())) == brute(rows, labels)


def test_long_text_and_no_rows(spark, documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = [(1, "word " * 300000, "en", None), (2, "word " * 300000, "en", None)]
    assert sorted(map(tuple, audit(documents(rows), labels).collect())) == brute(rows, [])
    assert audit(documents([]), labels).collect() == []


@pytest.mark.parametrize("n", [1, 2, 5])
def test_paths_through_the_lattice(n):
    forward, backward = path_counts(n)
    for state in range(1 << n):
        size = state.bit_count()
        assert (forward[state], backward[state]) == (factorial(size), factorial(n - size))
    assert all(sum(forward[s] * backward[s] for s in range(1 << n) if s.bit_count() == k) == factorial(n) for k in range(n + 1))


def test_other_filters(spark):
    """Three filters of one's own; shares add up to all that is removed in all orders."""
    cells = spark.createDataFrame([("p", m, 10 + m, m, 0) for m in range(8)], "part string, mask int, n long, good long, toxic long")
    rows = interactions(cells, "xyz").collect()
    assert len(rows) == 6 * 3
    shares = {r.filter_order[r.step - 1]: r.shapley for r in rows}
    assert sum(shares.values()) == 6 * sum(10 + m for m in range(1, 8))
    for a, b in combinations("xyz", 2):
        assert len({r.kept for r in rows if r.step == 2 and set(r.filter_order[:2]) == {a, b}}) == 1
    with pytest.raises(ValueError, match="filters"):
        interactions(cells, "xyzabcde")
