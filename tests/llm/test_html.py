import html
import os
import random
import re
import time

import numpy as np
import pytest

from headway.llm import html_text
from headway.llm.html_text import (
    BESIDE, FEATURES, BlockLabeller, blocks_of, extract, features, laid_out, learn, main_texts, sample_labels, train,
)

DATA = "/root/testdata/sf0.01"


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def sample(n):
    rng = random.Random(n)
    words = lambda a, b: " ".join("".join(rng.choice("aeioustnrl") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(a, b)))
    for _ in range(n):
        texts = "".join(f"<p>{words(8, 60)}.</p>" for _ in range(rng.randint(2, 9)))
        menu = "".join(f"<li><a href='/'>{words(1, 2)}</a></li>" for _ in range(5))
        yield page(f"<nav><ul>{menu}</ul></nav><div class='ad'>{words(4, 9)}</div><article><h1>{words(3, 8)}</h1>{texts}</article><footer>{words(4, 9)}</footer>")


@pytest.fixture(scope="module")
def model():
    return train(list(sample(60)))


def test_blocks():
    raw = """<body>bare&nbsp;text<div>a <b>bold</b>\n word<p>one<p>two <i>three</div>after
    <script>var x = "<p>no</p>";</script><style>p{}</style><!-- <p>no</p> --><ul><li>x<li>y<ul><li>z</ul></ul>
    <a href="a>b">li&amp;nk</a> &lt;tag&gt; &#233;&copy</body>"""
    assert blocks_of(raw).texts == ["bare text", "a bold word", "one", "two three", "after", "x", "y", "z", "li&nk <tag> é©"]


@pytest.mark.parametrize(
    ("raw", "texts"),
    [("", []), ("plain", ["plain"]), ("<p", ["<p"]), ("a < b", ["a < b"]), ("<p>x<!-- open", ["x"]), ("<script>x", []), ("</p></div>y", ["y"]),
     ("<title>no</title><p>é</p>", ["é"]), ("<head><p>in", ["in"]), ("<svg/><p>z", ["z"]), ("<p title='a>b\">c</p><p>d", ["b\">c", "d"])],
)
def test_broken_pages(raw, texts):
    assert blocks_of(raw).texts == texts


def test_batches_give_what_single_steps_give():
    model, rng = BlockLabeller(1), np.random.default_rng(0)
    pages = [rng.standard_normal((n, FEATURES)).astype(np.float32) for n in (1, 4, 0, 9, 2)]
    w = {k: v.astype(float) for k, v in model.weights.items()}
    logistic = lambda x: 1 / (1 + np.exp(-x))

    def states(rows, side):
        h = c = np.zeros(len(w["o"]) // 2)
        for row in rows:
            into, forget, out, new = np.split(row @ w[f"x{side}"] + w[f"c{side}"] + h @ w[f"h{side}"], 4)
            c = logistic(forget) * c + logistic(into) * np.tanh(new)
            h = logistic(out) * np.tanh(c)
            yield h

    for rows, found in zip(pages, model.scores(pages), strict=True):
        x = np.tanh(rows @ w["w"] + w["b"])
        both = zip(states(x, "f"), list(states(x[::-1], "b"))[::-1], strict=True)
        want = [logistic(np.concatenate(b) @ w["o"] + w["d"][0]) for b in both]
        assert found == pytest.approx(np.array(want), abs=1e-4)


def test_gradients_are_slopes():
    model, rng = BlockLabeller(2), np.random.default_rng(1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    pages = [rng.standard_normal((n, FEATURES)) for n in (3, 5)]
    labels = [rng.random(n) > 0.5 for n in (3, 5)]

    def loss():
        chance = np.concatenate(model.scores(pages))
        y = np.concatenate(labels)
        return -np.log(np.where(y, chance, 1 - chance)).mean()

    grads = model.gradients(pages, labels)
    for name in model.weights:
        weights = model.weights[name].reshape(-1)
        k = int(np.abs(grads[name]).argmax())
        weights[k] += 1e-2
        up = loss()
        weights[k] -= 2e-2
        slope = (up - loss()) / 2e-2
        weights[k] += 1e-2
        assert grads[name].reshape(-1)[k] == pytest.approx(slope, rel=0.05, abs=1e-4), name


def test_unseen_layouts(model):
    rng = random.Random(5)
    read = [blocks_of(x) for x in list(sample(97))[60:]]
    strange = [t for b in read for t in b.texts]
    wrong = total = 0
    for blocks in read:
        texts = [t for t, own in zip(blocks.texts, sample_labels(blocks), strict=True) if own]
        made, known = laid_out(rng, texts[0], texts[1:], strange)
        laid = blocks_of(made)
        scores = model.scores([features(laid)])[0]
        wrong += sum((s > 0.5) != known.get(t, False) for t, s in zip(laid.texts, scores, strict=True))
        total += len(scores)
    assert wrong < 0.03 * total


def test_main_text(model):
    beside = "".join(x.replace("{t}", "buy this now").replace("{w}", "more") for x in BESIDE[:12])
    text = "A first long enough sentence of the text, and more of it."
    made = page(f"{beside}<article><h1>Title of it</h1><p>{text}<p>{text} &amp;  more\n text</article><footer>end</footer>")
    assert main_texts(model, [made, None, "", page("")]) == [f"Title of it\n\n{text}\n\n{text} & more text", "", "", ""]


def test_rows(spark, model):
    rows = [(1, "u", next(iter(sample(1)))), (1, "u", next(iter(sample(1)))), (2, None, None), (None, "v", ""), (3, "w", page("<p>x</p>" * 20000))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = extract(pages, model).collect()
    assert [(r.page_id, r.url) for r in got] == [r[:2] for r in rows]
    assert all(r.n_chars == len(r.text) for r in got)
    assert got[0].text == got[1].text != "" and got[2].text == got[3].text == ""
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extract(empty).collect() == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")
def test_given_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages, learn(pages)).collect()}
    right = 0
    for r in pages.collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?p>|</?h1>|<br>", article)]
        right += got[r.page_id] == "\n\n".join(x for x in blocks if x)
    assert right >= 0.99 * pages.count()


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, "<a" * 500_000, '<a ">")' * 140_000 + "'", "<head>" * 170_000, "<div>" * 100_000 + "</x>" * 100_000,
     "<td><table>" + "<div>" * 60_000 + "<td>x</td>" * 60_000],
    ids=["open", "names", "quotes", "heads", "ends", "cells"],
)
def test_broken_markup_takes_linear_time(page):
    begin = time.process_time()
    blocks_of(page)
    assert time.process_time() - begin < 20


def test_tags_end_outside_quotes():
    assert blocks_of("<p title='a > b'>one</p><p x=\">two</p>three").texts == ["one", "two", "three"]
    assert blocks_of("a <b").texts == ["a <b"]
    assert blocks_of("a <!-- b").texts == ["a"]


def test_a_long_page_among_short_ones_is_labelled_alone():
    model = html_text.BlockLabeller()
    runs = []
    run = model._run
    model._run = lambda side, inputs, keep=None: (runs.append(inputs.shape[:2]), run(side, inputs, keep))[1]
    html_text.main_texts(model, ["<p>a b c</p>" * 50_000] + ["<p>x</p><p>y</p>"] * 63)
    assert {(50_000, 1), (2, 63)} == set(runs)


def test_without_article_elements_layouts_are_made_of_long_blocks():
    rng = random.Random(4)
    words = [f"w{rng.randrange(900)}" for _ in range(4000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    pages = [f"<div class='menu'><a href='/'>{text(2)}</a></div>" + "".join(f"<p>{text(30)}</p>" for _ in range(4)) for _ in range(60)]
    model = html_text.train(pages)
    wanted = [text(40), text(25), text(33)]
    page = "<nav><ul><li><a href='/'>Home</a></li></ul></nav><main>" + "".join(f"<p>{x}</p>" for x in wanted) + "</main><footer>x y</footer>"
    assert html_text.main_texts(model, [page]) == ["\n\n".join(wanted)]


def test_a_sample_without_blocks_takes_every_block_for_text():
    assert html_text.main_texts(html_text.train(["", "<br>"]), ["<p>a</p><nav>b</nav>"]) == ["a\n\nb"]
