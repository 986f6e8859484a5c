"""Language of a text by a convolutional network over its bytes, in numpy.

Filters of several widths run over byte embeddings; the largest response of each filter in a window feeds a softmax.
Embedding and filters together are tables: a filter's response at a place is the sum of one table entry per byte. A text
is judged on all its windows of fixed length: window log-probabilities are averaged by the bytes they hold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import checkpointed, if_small

#: Places of a window; a filter looks up to MARGIN bytes further.
WINDOW = 256
WIDTHS = (2, 3, 4)
MARGIN = max(WIDTHS) - 1
FILTERS = 16
EMBEDDING = 12
#: The bounded sample to learn from: about so many documents of each language, and evenly spaced cuts of each.
DOCS_PER_LANGUAGE = 400
CUTS = 6
CUT_CHARS = 300
EPOCHS = 5
#: Windows judged at once.
AT_ONCE = 64
UNKNOWN = "und"
#: Of doc_id's crc32; remainder 0 is held out.
FOLDS = 5

_LETTER = re.compile(r"[^\W\d_]")


def _symbols() -> np.ndarray:
    """Bytes as symbols: no case, one symbol each for white space, digits and other ASCII."""
    table = np.zeros(256, np.uint8)
    table[33:127] = 1
    table[ord("0") : ord("9") + 1] = 2
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = 3 + i
    table[128:] = 29 + np.arange(128)
    return table


SYMBOLS = _symbols()
N_SYMBOLS = int(SYMBOLS.max()) + 1


@dataclass
class ByteCnn:
    languages: list[str]
    embedding: np.ndarray  # symbol, dimension
    filters: list[np.ndarray]  # by width: place, dimension, filter
    bias: np.ndarray  # filter of all widths
    dense: np.ndarray  # filter of all widths, language
    base: np.ndarray  # language

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> ByteCnn:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        n = FILTERS * len(WIDTHS)
        filters = [normal(w, EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5) for w in WIDTHS]
        zeros = np.zeros
        return cls(
            languages,
            normal(N_SYMBOLS, EMBEDDING, scale=1.0),
            filters,
            zeros(n, np.float32),
            normal(n, len(languages), scale=0.1),
            zeros(len(languages), np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.dense, self.base]

    def pair_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses as sums of an entry for two neighbouring symbols and one for the two after them."""
        first = np.zeros((N_SYMBOLS, N_SYMBOLS, len(WIDTHS), FILTERS), np.float32)
        second = np.zeros_like(first)
        for k, f in enumerate(self.filters):
            for j, weights in enumerate(f):
                table = self.embedding @ weights
                part = first if j < 2 else second
                part[:, :, k] += table[:, None] if j % 2 == 0 else table[None, :]
        return first.reshape(N_SYMBOLS**2, -1), second.reshape(N_SYMBOLS**2, -1)

    def log_probabilities(self, pooled: np.ndarray) -> np.ndarray:
        scores = np.maximum(pooled + self.bias, 0) @ self.dense + self.base
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def windows_of(text: bytes) -> np.ndarray:
    """The whole text's symbols as rows of WINDOW places and MARGIN more; spaces fill the last."""
    n = max(1, -(-len(text) // WINDOW))
    padded = np.zeros(n * WINDOW + MARGIN, np.uint8)
    padded[: len(text)] = SYMBOLS[np.frombuffer(text, np.uint8)]
    return np.lib.stride_tricks.as_strided(padded, (n, WINDOW + MARGIN), (WINDOW, 1))


class Judge:
    """Applies a model to texts, a bounded number of windows at a time."""

    def __init__(self, model: ByteCnn):
        self.model = model
        self.first, self.second = model.pair_tables()

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """Log-probabilities by language of each window."""
        out = []
        for k in range(0, len(rows), AT_ONCE):
            symbols = rows[k : k + AT_ONCE].astype(np.int32)
            pairs = symbols[:, :-1] * N_SYMBOLS + symbols[:, 1:]
            found = self.first[pairs[:, :WINDOW]]
            found += self.second[pairs[:, 2 : WINDOW + 2]]
            out.append(self.model.log_probabilities(found.max(axis=1)))
        return np.concatenate(out)

    def texts(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text; texts without a letter are unknown."""
        answers: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not self.model.languages:
            return answers
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
        held = 0

        def settle() -> None:
            logs = self.windows(np.concatenate([rows for _, rows, _ in waiting]))
            at = 0
            for i, rows, weights in waiting:
                mean = weights @ logs[at : at + len(rows)] / weights.sum()
                at += len(rows)
                share = np.exp(mean - mean.max())
                best = int(share.argmax())
                answers[i] = self.model.languages[best], float(min(1.0, share[best] / share.sum()))

        for i, text in enumerate(texts):
            if not text or not _LETTER.search(text):
                continue
            raw = text.encode()
            rows = windows_of(raw)
            weights = np.full(len(rows), float(WINDOW))
            weights[-1] = len(raw) - WINDOW * (len(rows) - 1)
            waiting.append((i, rows, weights))
            held += len(rows)
            if held >= 4 * AT_ONCE:
                settle()
                waiting, held = [], 0
        if waiting:
            settle()
        return answers


def train(samples: list[tuple[str, str]], seed: int = 7, epochs: int = EPOCHS, batch: int = 64) -> ByteCnn:
    """A model from (language, text) pieces. Half of the time a window is cut short, as short documents are."""
    languages = sorted({lang for lang, _ in samples})
    rng = np.random.default_rng(seed)
    model = ByteCnn.fresh(languages, rng)
    if len(languages) < 2:
        return model
    labels = np.array([languages.index(lang) for lang, _ in samples])
    rows = np.concatenate([windows_of(text.encode()[:WINDOW]) for _, text in samples])
    weight = len(samples) / (len(languages) * np.bincount(labels, minlength=len(languages)))
    means = [np.zeros_like(w) for w in model.weights()]
    squares = [np.zeros_like(w) for w in model.weights()]
    steps, total = 0, epochs * -(-len(rows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(rows), batch):
            chosen = order[k : k + batch]
            x, y = rows[chosen].copy(), labels[chosen]
            short = rng.random(len(x)) < 0.5
            ends = np.where(short, rng.integers(16, WINDOW, len(x)), WINDOW + MARGIN)
            x[np.arange(x.shape[1]) >= ends[:, None]] = 0
            steps += 1
            rate = 0.01 * (1 - 0.9 * steps / total)
            for w, g, m, s in zip(model.weights(), _gradients(model, x, y, weight[y]), means, squares, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= (rate * (m / (1 - 0.9**steps)) / (np.sqrt(s / (1 - 0.99**steps)) + 1e-6)).astype(np.float32)
    return model


def _gradients(model: ByteCnn, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n = len(x)
    tables = [[model.embedding @ weights for weights in f] for f in model.filters]
    pooled, places = [], []
    for f in tables:
        found = sum(table[x[:, j : j + WINDOW]] for j, table in enumerate(f))
        at = found.argmax(axis=1)
        places.append(at)
        pooled.append(np.take_along_axis(found, at[:, None], axis=1)[:, 0])
    pre = np.concatenate(pooled, axis=1) + model.bias
    active = np.maximum(pre, 0)
    wrong = np.exp(model.log_probabilities(np.concatenate(pooled, axis=1)))
    wrong[np.arange(n), y] -= 1
    wrong *= (weight / n)[:, None]
    back = (wrong @ model.dense.T) * (pre > 0)
    embedding = np.zeros_like(model.embedding)
    filters = []
    for k, f in enumerate(model.filters):
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        change = np.zeros_like(f)
        for j in range(len(f)):
            symbols = x[np.arange(n)[:, None], places[k] + j]
            change[j] = np.einsum("bfd,bf->df", model.embedding[symbols], own)
            np.add.at(embedding, symbols, own[:, :, None] * f[j].T[None])
        filters.append(change)
    return [embedding, *filters, back.sum(axis=0), active.T @ wrong, wrong.sum(axis=0)]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learn(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, cuts: int = CUTS) -> ByteCnn:
    """A model from the rows of `docs` that aren't held out and have a doc_id, a language and text.

    Of every language about `docs_per_language` documents come to the driver, chosen by a hash of doc_id, each as at
    most `cuts` cuts of CUT_CHARS characters spread over the whole text; so what the driver gets is bounded by
    the number of languages. The counts by language cover all rows.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = checkpointed(known.groupBy("lang").count())
    share = counts.select(F.col("lang").alias("of"), (docs_per_language / F.col("count")).alias("share"))
    share = if_small(share, counts.count())  # one row a language; else all texts of one meet in a task
    size = F.length("text")
    last = F.greatest(size - CUT_CHARS, F.lit(0))
    starts = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(cuts - 1)), lambda i: F.floor(last * i / max(1, cuts - 1))))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    picked = known.select("doc_id", "lang", "text").join(share, F.col("lang") == F.col("of")).where(chance < F.col("share"))
    pieces = picked.where(F.col("text").rlike(r"\p{L}")).select(
        "lang", "doc_id", F.transform(starts, lambda at: F.col("text").substr(at.cast("int") + 1, F.lit(CUT_CHARS))).alias("pieces")
    )
    rows = sorted(pieces.collect(), key=lambda r: (r["lang"], r["doc_id"], r["pieces"]))
    return train([(r["lang"], piece) for r in rows for piece in r["pieces"] if piece])


def predicted(text: Column, model: ByteCnn) -> Column:
    """A struct of lang_pred and score for whole texts."""

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        made = Judge(model)
        for texts in batches:
            yield pd.DataFrame(made.texts(list(texts)), columns=["lang_pred", "score"])

    return judge(text)


def identify_languages(docs: DataFrame, model: ByteCnn | None = None) -> DataFrame:
    """For every row doc_id, held_out, lang_pred and score, by a model learnt from `docs` where none is given.

    Texts that are null or have no letter are `und` with score 0, and so is everything if no row has a language.
    A prediction depends on the text alone: repeated rows get the same, and columns beside doc_id, text and lang
    aren't read.
    """
    model = model or learn(docs)
    found = docs.select("doc_id", predicted(F.col("text"), model).alias("found"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score")


def in_known_language(docs: DataFrame, least: float, model: ByteCnn | None = None) -> DataFrame:
    """The rows of `docs`, with their columns, whose text has a language with at least that score."""
    model = model or learn(docs)
    found = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predicted(F.col("text"), model).alias("found")
    kept = docs.select(*found).where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= least))
    return kept.select("row.*")
