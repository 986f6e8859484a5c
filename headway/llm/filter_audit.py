"""What each filter of a chain removes in every order of the chain, and its Shapley share, by counting paths.

A document is what filters it fails, so a part of the corpus is at most 2**n cells of counts. The states of a chain are
the sets of filters applied so far; its steps are the edges of that lattice, and all orders that apply filter f after the
same set S, in whatever order, share one edge. Counting the orders that reach S (forward) and those that leave S + f for
the end (backward) says how many orders use the edge: the Shapley share of f is the sum over its edges of removals times
that number, and the steps of a single order are read from the edges it passes. Nothing is evaluated once per order.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import checkpointed

#: With n filters the result has n! orders of n steps a part.
MOST_FILTERS = 7
LEAST_WORDS = 200


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For every set of n filters, as bits: the orders that reach it from none, and those that go on from it to all."""
    forward, backward = [1] + [0] * ((1 << n) - 1), [0] * ((1 << n) - 1) + [1]
    bits = [1 << k for k in range(n)]
    for state in range(1 << n):  # a set comes after all its subsets
        for bit in bits:
            if not state & bit:
                forward[state | bit] += forward[state]
    for state in reversed(range(1 << n)):
        backward[state] += sum(backward[state | bit] for bit in bits if not state & bit)
    return forward, backward


def interactions(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """The audit of `cells` (part, mask, n, good, toxic): counts of documents by part and by the filters that they fail,
    the k-th name being bit k. Returns the rows of `audit`.

    Both tables joined here are fixed by the number of filters, at most MOST_FILTERS (else ValueError).
    """
    n = len(names)
    if not 0 < n <= MOST_FILTERS or len(set(names)) < n:
        raise ValueError(f"1 to {MOST_FILTERS} filters, each once, not {list(names)}")
    spark = cells.sparkSession
    forward, backward = path_counts(n)
    edges = [(s, 1 << k, forward[s] * backward[s | 1 << k]) for s in range(1 << n) for k in range(n) if not s >> k & 1]
    # every mask has a row for every edge, so a part has all its edges, with counts of zero too
    meets = [(m, s, bit, paths, not m & s, bool(m & bit), m == bit) for m in range(1 << n) for s, bit, paths in edges]
    meets = spark.createDataFrame(meets, "mask int, before int, bit int, paths long, alive boolean, fails boolean, alone boolean")
    walks = [
        ("".join(names[k] for k in order), step + 1, sum(1 << k for k in order[:step]), 1 << k)
        for order in permutations(range(n))
        for step, k in enumerate(order)
    ]
    walks = spark.createDataFrame(walks, "filter_order string, step int, before int, bit int")

    def total(which: Column, what: str = "n") -> Column:
        return F.sum(F.when(which, F.col(what)).otherwise(0))

    here = F.col("alive") & F.col("fails")
    counted = (
        cells.join(F.broadcast(meets), "mask")
        .groupBy("part", "before", "bit", "paths")
        .agg(
            total(F.col("alive") & ~F.col("fails")).alias("kept"),
            total(here).alias("removed"),
            total(F.col("fails") & ~F.col("alive")).alias("redundant"),
            total(F.col("alone")).alias("unique_fails"),
            total(here, "good").alias("good_lost"),
            total(here, "toxic").alias("toxic_lost"),
        )
    )
    share = F.sum(F.col("paths") * F.col("removed")).over(Window.partitionBy("part", "bit"))  # 2**(n-1) edges each
    counted = counted.withColumn("shapley", share)
    out = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return counted.join(F.broadcast(walks), ["before", "bit"]).select("part", "filter_order", "step", *out)


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of a text and its words, by letter."""
    n_words = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n_words,
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part and mask of every document: bits 0 to 3 for the text filters A to D, bit 4 (E) where a smaller doc_id of
    the whole table has the very same text.

    Texts are read once; what is shuffled is their SHA-256 digest. Each digest's least doc_id is aggregated before it is
    joined, and joined on (digest, doc_id), so a text that a third of all documents share is no hot key.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    worded = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    worded = worded.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    failed = text_filters(F.col("text"), F.col("words"))
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failed.values())), F.lit(0))
    narrow = checkpointed(
        worded.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    )
    first = narrow.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return narrow.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", F.when(copy, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask")
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The five filters of `failures` applied to `docs` in all 120 orders, part by part.

    Returns per part, filter_order and step the counts kept (after the step), removed (here), redundant (failing this
    filter, removed earlier), unique_fails (failing this filter alone), good_lost and toxic_lost (removed here with
    quality = 1, toxic = 1 in `labels`), and shapley (what this filter removes, summed over all orders).

    A null text is the empty text (it fails A only, and E if it repeats), a null part the empty string. Every row counts:
    rows that repeat a doc_id are documents of their own, and no copies of each other. A null doc_id is smaller than none,
    so such a row neither fails E nor makes others fail. Of several label rows of a doc_id any may say good or toxic; documents without
    one are neither. Texts are whole, however long. Without documents there are no rows. Other columns are ignored.
    """
    label = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id")
    label = label.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = failures(docs, part).join(label, "doc_id", "left")
    cells = marked.groupBy("part", "mask").agg(F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")))
    return interactions(cells, "ABCDE")
