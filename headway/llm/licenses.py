"""Licence scan by ordered signature rules, with DataFrame operations alone.

A text becomes its words between single spaces. Documents without any rule's keyword are passed over; in the others a rule
is tried if its keyword occurs. A detection is an interval of words; one that lies within the interval of a detection of the
same or a better priority is dropped, so the most exact signature names the licence. Phrases of the base always
count. Everything stays in its row: no shuffle, whatever the length of texts or lists of detections.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import lower_ascii
from headway.llm.license_rules import PRIORITIES, RULES, Rule

#: Phrases that always count, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
BASE_CONFIDENCE = 0.6
#: Places or detections whose running values are worked out together.
BLOCK = 256
_BEGIN, _END = "\x01", "\x02"
_PLACES = "array<struct<first:int,last:int>>"
_SPAN = "struct<first:int,last:int,priority:int,label:string,confidence:double>"


def normalized(text: Column) -> Column:
    """A space, then every word and a space; words are runs of digits, letters and whatever is not ASCII."""
    words = F.trim(F.regexp_replace(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once; within a lambda an expression used twice is evaluated twice."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _along(
    items: Column,
    start: Column,
    state: str,
    after: Callable[[Column, Column], Column],
    made: Callable[[Column, Column], Column],
    kind: str,
) -> Column:
    """made(state before the item, item) for every item, in order, where after(state, item) is the state that follows.

    An array that grows by one is copied each time, so the items are taken in blocks: first the state before each block,
    then the items of each block by themselves. What is copied is BLOCK / 2 results an item and a state for each pair of blocks.
    """

    def grown(array: Column, item: Column) -> Column:
        return F.concat(array, F.array(item))

    def within(block: Column, begin: Column) -> Column:
        none = F.struct(begin.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(
            block,
            none,
            lambda s, x: F.struct(after(s["state"], x).alias("state"), grown(s["out"], made(s["state"], x)).alias("out")),
            lambda s: s["out"],
        )

    def before(blocks: Column) -> Column:
        none = F.struct(start.alias("state"), F.array().cast(f"array<{state}>").alias("out"))
        return F.aggregate(
            blocks,
            none,
            lambda s, block: F.struct(
                F.aggregate(block, s["state"], after).alias("state"), grown(s["out"], s["state"]).alias("out")
            ),
            lambda s: s["out"],
        )

    def cut(items: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
        return F.transform(blocks, lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)))

    some = _let(items, lambda i: _let(cut(i), lambda blocks: F.flatten(F.zip_with(blocks, before(blocks), within))))
    return F.when(F.size(items) > 0, some).otherwise(F.array().cast(f"array<{kind}>"))


def places(padded: Column, pattern: Column) -> Column:
    """(first, last) words of all places of a pattern of whole words, in order, one after the other."""
    whole = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    marked = F.split(F.regexp_replace(padded, whole, F.lit(f"{_BEGIN}$0{_END}")), _BEGIN)

    def found(parts: Column) -> Column:
        before = _along(
            F.transform(parts, _spaces), F.lit(0), "int", lambda sum_, n: sum_ + n, lambda sum_, n: sum_, "int"
        )

        def place(part: Column, first: Column) -> Column:
            return F.struct(first.alias("first"), (first + _spaces(F.substring_index(part, _END, 1))).alias("last"))

        starts = F.transform(before, lambda n: n - 1)
        rest = F.greatest(F.size(parts) - 1, F.lit(0))
        return F.zip_with(F.slice(parts, 2, rest), F.slice(starts, 2, rest), place)

    return _let(marked, lambda parts: F.when(F.size(parts) > 1, found(parts)).otherwise(F.array().cast(_PLACES)))


def _literal(rules: tuple[Rule, ...]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.confidence).alias("confidence"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.pattern).alias("pattern"),
            )
            for r in rules
        ]
    )


def any_keyword(rules: tuple[Rule, ...]) -> str:
    """A pattern of all keywords of the rules, by their first two characters, so that few are tried at a place."""
    ends = defaultdict(lambda: defaultdict(set))
    for keyword in {r.keyword for r in rules}:
        ends[keyword[:1]][keyword[1:2]].add(re.escape(keyword[2:]))
    choice = lambda parts: "(?:" + "|".join(parts) + ")"
    seconds = {
        first: choice(re.escape(second) + choice(sorted(rest)) for second, rest in sorted(group.items()))
        for first, group in sorted(ends.items())
    }
    return "|".join(re.escape(first) + rest for first, rest in seconds.items())


def detections(padded: Column, rules: tuple[Rule, ...]) -> Column:
    """All places of the rules whose keyword occurs, in the order of their first words, longer ones first, and better
    priorities first where these are equal."""

    def of(rule: Column) -> Column:
        return F.transform(
            places(padded, rule["pattern"]),
            lambda at: F.struct(
                at["first"].alias("first"),
                (-at["last"]).alias("minus_last"),
                rule["priority"].alias("priority"),
                rule["label"].alias("label"),
                rule["confidence"].alias("confidence"),
            ),
        )

    tried = F.filter(_literal(rules), lambda rule: F.contains(padded, rule["keyword"]))
    ordered = F.array_sort(F.flatten(F.transform(tried, of)))
    return F.transform(
        ordered,
        lambda d: F.struct(
            d["first"], (-d["minus_last"]).alias("last"), d["priority"], d["label"], d["confidence"]
        ).cast(_SPAN),
    )


def unsuppressed(found: Column) -> Column:
    """Ordered detections without those inside an earlier one of the same or a better priority. An interval that holds
    another comes before it, so the furthest end so far of each priority tells."""

    def after(ends: Column, d: Column) -> Column:
        return F.struct(
            *[
                F.when(d["priority"] == p, F.greatest(ends[f"end{p}"], d["last"])).otherwise(ends[f"end{p}"]).alias(f"end{p}")
                for p in range(1, PRIORITIES + 1)
            ]
        )

    def kept(ends: Column, d: Column) -> Column:
        inside = reduce(
            lambda a, b: a | b, [(d["priority"] >= p) & (ends[f"end{p}"] >= d["last"]) for p in range(1, PRIORITIES + 1)]
        )
        return F.when(~inside, d)

    start = F.struct(*[F.lit(-1).alias(f"end{p}") for p in range(1, PRIORITIES + 1)])
    state = "struct<" + ",".join(f"end{p}:int" for p in range(1, PRIORITIES + 1)) + ">"
    return F.filter(_along(found, start, state, after, kept, _SPAN), lambda d: d.isNotNull())


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For every row doc_id, n_words, the places of the base phrases (n_base, first_word, last_word), base_labels, labels,
    score (the confidence of the surest detection, 0 without one), and detections: what is left of them, with the first
    and last word of each.

    A null text is empty: no words, no labels, score 0. Rows come back one for one, repeated ones too; other columns
    than doc_id and text aren't read; an empty table gives an empty one. Long texts are scanned whole; the time grows with
    their length and, for n places, with n * BLOCK.
    """
    rows = docs.select("doc_id", normalized(F.col("text")).alias("padded"))
    padded = F.col("padded")
    anchored = padded.rlike(any_keyword(rules)) if rules else F.lit(False)
    licensed = F.contains(padded, F.lit(" license "))
    none = F.array().cast(_PLACES)
    rows = rows.select(
        "doc_id",
        F.greatest(_spaces(padded) - 1, F.lit(0)).cast("long").alias("n_words"),
        *[
            F.when(licensed & F.contains(padded, F.lit(phrase)), places(padded, F.lit(phrase))).otherwise(none).alias(label)
            for phrase, label in BASE
        ],
        F.when(anchored, unsuppressed(detections(padded, rules))).otherwise(F.array().cast(f"array<{_SPAN}>")).alias("detections"),
    )
    labels = [label for _, label in BASE]
    starts = F.transform(F.concat(*labels), lambda at: at["first"].cast("long"))
    base = F.filter(F.array(*[F.when(F.size(label) > 0, F.lit(label)) for label in labels]), lambda x: x.isNotNull())
    both = F.concat(base, F.transform("detections", lambda d: d["label"]))
    sure = F.array_max(F.transform("detections", lambda d: d["confidence"]))
    return rows.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(both)), ",").alias("labels"),
        F.coalesce(F.greatest(sure, F.when(F.size(base) > 0, F.lit(BASE_CONFIDENCE))), F.lit(0.0)).alias("score"),
        "detections",
    )
