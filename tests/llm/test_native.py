"""Mixing, URL lists and licence rules."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict

import pytest
from llm_tables import clashing, documents  # noqa: F401
from pyspark.sql import functions as F

from headway.llm.license_rules import RULES, Rule
from headway.llm.licenses import BASE, BLOCK, scan
from headway.llm.mixing import fit, mixed, mixture, tempered_targets
from headway.llm.url_lists import host_of, judged, names_above, validity


def native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    return df


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(["word"] * rng.randint(1, 40)) + rng.choice(["", "", "!!", " | x", " licence"])
        rows.append((i, text, rng.choice(["en", "en", "en", "fr", None]), rng.choice(["a"] * 5 + ["b", "c", None])))
    return rows


def test_marginals_are_met(spark, documents):
    docs = documents(corpus(3000))
    rows = native(mixed(docs)).collect()
    for column, exponent in (("source", 0.7), ("lang", 0.7), ("topic", 0.9)):
        had, got = Counter(), Counter()
        for r in rows:
            had[r[column]] += r.n_tokens
            got[r[column]] += r.n_tokens * r.probability
        total = sum(x**exponent for x in had.values())
        for value in had:
            assert got[value] / sum(got.values()) == pytest.approx(had[value] ** exponent / total, rel=1e-4)
    assert max(r.probability for r in rows) == 1
    assert sum(r.sampled for r in rows) == pytest.approx(sum(r.probability for r in rows), rel=0.05)


def test_given_targets_and_size(spark, documents):
    docs = documents([(i, "w " * 10, "en" if i % 4 else "fr", "a" if i % 2 else "b") for i in range(4000)])
    table = lambda rows: spark.createDataFrame(rows, "value string, share double")
    targets = {
        "source": table([("a", 1.0), ("b", 1.0), ("absent", 2.0)]),
        "lang": table([("en", 3.0), ("fr", 1.0)]),
        "topic": table([("prose", 1.0)]),
    }
    rows = mixed(docs, targets=targets, tokens=8000).collect()
    assert sum(r.n_tokens * r.probability for r in rows) == pytest.approx(8000, rel=1e-4)
    # fr is within b only
    assert sum(r.probability for r in rows if r.lang == "fr") == pytest.approx(200, rel=1e-3)
    assert sum(r.probability for r in rows if r.source == "a") == pytest.approx(400, rel=1e-3)
    without = mixed(docs, targets={**targets, "lang": table([("en", 1.0)])}).collect()
    assert {r.probability for r in without if r.lang == "fr"} == {0.0}


def test_fit_equals_plain_fitting(spark):
    rng = random.Random(2)
    cells = [(a, b, rng.randint(0, 90)) for a in "xyz" for b in "pqrs"]
    df = spark.createDataFrame(cells, "s string, l string, tokens bigint")
    got = fit(df, {c: tempered_targets(df, c, 0.5) for c in ("s", "l")}, tolerance=1e-12)
    factor = {(a, b): 1.0 for a, b, _ in cells}
    for _ in range(200):
        for k in (0, 1):
            sums, now = defaultdict(float), defaultdict(float)
            for c in cells:
                sums[c[k]] += c[2]
                now[c[k]] += c[2] * factor[c[:2]]
            total = sum(x**0.5 for x in sums.values())
            for c in cells:
                factor[c[:2]] *= sums[c[k]] ** 0.5 / total / now[c[k]]
    for r in got.collect():
        assert r.factor == pytest.approx(factor[r.s, r.l], rel=1e-9)


def test_mixing_edges(documents, clashing):
    rows = [(1, None, None, None), (2, "", "en", "empty"), (3, "a b", "en", None), (3, "a b", "en", None), (None, "c " * 50000, None, "s")]
    docs = clashing(documents(rows))
    got = mixed(docs).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 50000), (1, 0), (2, 0), (3, 2), (3, 2)]
    assert {r.sampled for r in got if r.n_tokens == 0} == {False}
    assert all(0 <= r.probability <= 1 for r in got)
    assert len({r.sampled for r in got if r.doc_id == 3}) == 1
    assert mixture(docs).columns == docs.columns
    assert mixed(documents([])).collect() == [] and mixture(documents([])).collect() == []
    assert not any(r.sampled for r in mixed(documents([(1, None), (2, " ")])).collect())


D = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)


def test_hosts(spark):
    urls = ["http://A.b.Example.com:80/x?y#z", "https://u:p@h.org", "h.org/x", "http://h.org.", None, "", "ftp://1.2.3.4/", "http:///x", "http://h.org?q", "HTTP://[::1]/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    got = [r[0] for r in df.orderBy("i").select(host_of(F.col("u"))).collect()]
    assert got == ["a.b.example.com", "h.org", "", "h.org", "", "", "1.2.3.4", "", "h.org", ""]
    above = [r[0] for r in df.orderBy("i").select(names_above(host_of(F.col("u")))).collect()]
    assert above[0] == ["a.b.example.com", "b.example.com", "example.com", "com"] and above[6] == ["1.2.3.4"]


def entries(spark, rows):
    return spark.createDataFrame(rows, "name string, list string, kind string, day date, action string").selectExpr("*", "1 AS bucket", "2 AS host")


def test_validity(spark):
    rows = [("h", "l", "block", D(k), a) for k, a in ((5, "add"), (3, "add"), (9, "remove"), (9, "remove"), (12, "remove"), (20, "add"), (20, "remove"))]
    rows += [("H", "m", "block", D(1), "remove"), (None, "l", "block", D(1), "add"), ("x", "l", "block", None, "add")]
    got = sorted(map(tuple, validity(entries(spark, rows)).collect()))
    assert got == [("h", "l", "block", D(3), D(9)), ("h", "l", "block", D(20), None)]


def test_judged_equals_day_by_day(spark):
    rng = random.Random(3)
    names = ["com", "a.com", "b.a.com", "c.b.a.com", "z.org", "1.2.3.4", "4"]
    given = [(rng.choice(names), rng.choice("lmn"), "block", D(rng.randrange(200)), rng.choice(("add", "add", "remove"))) for _ in range(60)]
    given += [(n, "ok", "allow", D(rng.randrange(200)), "add") for n in names[1:4]]
    hosts = ["a.com", "x.b.a.com", "c.b.a.com", "z.org", "q.z.org", "1.2.3.4", "none.net"]
    captures = [(i, f"http://{rng.choice(hosts)}/{i}", D(rng.randrange(-5, 230))) for i in range(400)]
    captures += [captures[0], (500, None, D(3)), (501, "http://a.com/", None), (None, "http://a.com/", D(150)), (502, "nonsense", D(9))]
    table = spark.createDataFrame(captures, "page_id bigint, url string, fetched_on date").selectExpr("*", "1 AS bucket", "2 AS name", "3 AS lists")
    state = {}
    for name, on, kind, day, action in given:
        state.setdefault((name, on, kind), {})
        state[name, on, kind][day] = state[name, on, kind].get(day, False) or action == "add"

    def valid(key, day):
        past = [d for d in state[key] if d <= day]
        return bool(past) and state[key][max(past)]

    want = []
    for page_id, url, day in captures:
        host = url.split("/")[2] if url and "//" in url else ""
        labels = host.split(".")
        above = [host] if re.fullmatch("[0-9.]+", host) else [".".join(labels[k:]) for k in range(len(labels))]
        found = [k for k in state if host and day and k[0] in above and valid(k, day)]
        top = max(found, key=lambda k: (len(k[0]), k[2] == "allow"), default=None)
        want.append((page_id, url, day, host, bool(top) and top[2] == "block", top and top[0], ",".join(sorted({k[1] for k in found}))))
    got = native(judged(table, entries(spark, given))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_no_lists_and_no_captures(spark):
    captures = spark.createDataFrame([(1, "http://a.com/", D(1))], "page_id bigint, url string, fetched_on date")
    assert [tuple(r) for r in judged(captures, entries(spark, [])).collect()] == [(1, "http://a.com/", D(1), "a.com", False, None, "")]
    assert judged(captures.where("false"), entries(spark, [("a.com", "l", "block", D(0), "add")])).collect() == []


def by_hand(text, rules=RULES):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    padded = " " + " ".join(words) + " " if words else " "
    starts, base = [], set()
    for phrase, label in BASE:
        parts = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += here
        base |= {label} if here else set()
    found = []
    for rule in rules:
        if rule.keyword in padded:
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", padded):
                first = padded[: m.start()].count(" ") - 1
                found.append((first, first + m[0].count(" "), rule.priority, rule.label, rule.confidence))
    left = []
    for k, (first, last, priority, label, confidence) in enumerate(found):
        inside = [
            j
            for j, o in enumerate(found)
            if j != k and o[0] <= first and o[1] >= last and o[2] <= priority
            and ((o[0], o[1], o[2]) != (first, last, priority) or (o[3], o[4], j) < (label, confidence, k))
        ]
        if not inside:
            left.append((label, confidence))
    score = max([c for _, c in left] + [0.6] * bool(base), default=0.0)
    place = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *place, ",".join(sorted(base)), ",".join(sorted(base | {x for x, _ in left})), score


TEXTS = [
    None, "", " .,", "MIT License", "the MIT License, mit license; MIT-License and Apache License", "mitlicense mit licenses", "Released under the MIT License.",
    "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.",
    "General Public License " * 400, "é mit license É", "SPDX-License-Identifier: GPL-2.0-or-later OR MIT", "nicht mit der Lizenz mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")",
    "GNU Lesser General Public License v2.1 and Mozilla Public License 2.0", "all rights reserved, licence MPL 1.1", "word " * 30000 + "mit license",
    "licensed under the terms of the BSD 3-Clause License; 2-clause BSD license", "\x01 mit license \x02 $0 \\1 license",
]


def test_scan_equals_plain_search(documents, clashing):
    rows = list(enumerate(TEXTS)) + [(3, "MIT License"), (None, "mit license")]
    got = native(scan(clashing(documents(rows))).drop("detections")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(d, *by_hand(t)) for d, t in rows], key=repr)
    assert scan(documents([])).collect() == []


def test_many_places_of_one_text(documents):
    blocks = "all rights reserved mit license, Apache License version 2.0 gpl " * (BLOCK + 50)
    many = "mit license x general public license " * 50000
    got = {r.doc_id: r for r in scan(documents([(1, blocks), (2, many)])).collect()}
    assert tuple(got[1])[1:-1] == by_hand(blocks)
    assert (got[2].n_words, got[2].n_base, got[2].first_word, got[2].last_word) == (300000, 100000, 0, 299997)
    ends = [(d.first, d.last) for d in got[2].detections if d.label == "mit"]
    assert ends == [(6 * k, 6 * k + 1) for k in range(50000)]


def test_containment_and_priority(documents):
    rules = tuple(Rule(label, p, 1 / p, "x", pattern) for label, p, pattern in (("whole", 1, "a b c d"), ("part", 1, "b c"), ("better", 1, "q r"), ("worse", 2, "q r s"), ("same", 1, "q r"), ("cross", 2, "d e")))
    rows = [(1, "x license a b c d"), (2, "x license b c"), (3, "x license q r s"), (4, "x license a b c d e")]
    got = {r.doc_id: r.labels for r in scan(documents(rows), rules).collect()}
    assert got == {1: "whole", 2: "part", 3: "better,worse", 4: "cross,whole"}


def test_there_are_hundreds_of_rules():
    assert len(RULES) > 300 and len({r.label for r in RULES}) > 100
    for rule in RULES:
        re.compile(rule.pattern)
