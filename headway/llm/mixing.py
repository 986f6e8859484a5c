"""Mixing a corpus to target token shares by iterative proportional fitting, with DataFrame operations alone.

Documents are summed to cells of all mixed columns. Fitting scales the cells to the target shares of one column after
another until no column moves any more; only cells, never documents, are shuffled for it. A cell's factor makes
the probability with which each of its documents is drawn.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import checkpointed, fresh, if_small

#: The largest relative change of a cell in a sweep at which fitting has converged, and the most sweeps.
TOLERANCE = 1e-6
SWEEPS = 60
#: The share of a corpus' tokens that is drawn where no number of tokens is given.
SHARE = 2 / 3
#: The factor of cells of a value that is taken whole, so that the other columns leave them whole.
WHOLE = 1e6
#: Exponents that temper a column's own token shares to targets: 0 makes values equal, 1 leaves them.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.9}
SEED = "mix"
#: Kinds of documents by what their text holds, the first that applies; documents beside them are prose.
TOPICS = (
    ("empty", r"^[ \t\r\n]*$"),
    ("licence", r"[Ll]icen[cs]e"),
    ("credentials", r"(token|password|secret|key) *[=:]"),
    ("shouting", r"!!"),
    ("table", r" \| "),
    ("junk", r"###|%%%|&&&"),
)
PROSE = "prose"


def token_weight(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\r\n]+")).cast("long")


def topic_of(text: Column) -> Column:
    found = [F.when(F.coalesce(text, F.lit("")).rlike(pattern), F.lit(name)) for name, pattern in TOPICS]
    return F.coalesce(*found, F.lit(PROSE))


def tempered_targets(cells: DataFrame, column: str, exponent: float) -> DataFrame:
    """(value, share): the column's token shares to the power of `exponent`, as shares again by whoever uses them."""
    sums = cells.groupBy(F.col(column).alias("value")).agg(F.sum("tokens").alias("tokens"))
    return sums.where("tokens > 0").select("value", F.pow(F.col("tokens").cast("double"), F.lit(exponent)).alias("share"))


def _normalized(cells: DataFrame, column: str, targets: DataFrame) -> DataFrame:
    """(value, share) of the values that have tokens, with shares that add up to 1."""
    here = cells.where("tokens > 0").select(F.col(column).alias("has")).distinct()
    shares = checkpointed(targets.join(here, F.expr("has <=> value"), "left_semi"))
    total = shares.agg(F.sum("share")).first()[0] or 1.0
    return shares.select("value", (F.col("share") / F.lit(float(total))).alias("share"))


def _rescaled(cells: DataFrame, column: str, targets: DataFrame) -> DataFrame:
    """Cells with their factor changed so that each of the column's values has its share; values without a target get
    factor 0."""
    now = cells.groupBy(F.col(column).alias("has")).agg(F.sum(F.col("tokens") * F.col("factor")).alias("mass"))
    change = now.where("mass > 0").join(targets, F.expr("has <=> value"))
    change = change.select("has", (F.col("share") / F.col("mass")).alias("by"))
    by = F.coalesce("by", F.lit(0.0))
    moved = F.greatest("moved", F.when(F.col("tokens") * F.col("factor") > 0, F.abs(by - 1)).otherwise(0.0))
    joined = cells.join(change, F.expr(f"`{column}` <=> has"), "left")
    return joined.withColumn("moved", moved).withColumn("factor", F.col("factor") * by).drop("has", "by")


def _wanted(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Cells with factor 1, or 0 where a column's value has no target."""
    cells = cells.withColumns({"factor": F.lit(1.0), "moved": F.lit(0.0)})
    for column, table in targets.items():
        named = table.where("share > 0").select(F.col("value").alias("has"), F.lit(1.0).alias("by"))
        joined = cells.join(named, F.expr(f"`{column}` <=> has"), "left")
        cells = joined.withColumn("factor", F.col("factor") * F.coalesce("by", F.lit(0.0))).drop("has", "by")
    return checkpointed(cells)


def _tokens_of(cells: DataFrame, column: str, targets: DataFrame, tokens: float) -> DataFrame:
    """(value, target): `tokens` dealt out by the values' shares. A value takes no more than it has, and what it can't
    take goes to the others, by their shares."""
    held = cells.where("tokens * factor > 0").groupBy(F.col(column).alias("has"))
    held = held.agg(F.sum("tokens").cast("double").alias("held"))
    shares = checkpointed(targets.where("share > 0").join(held, F.expr("has <=> value")).select("value", "share", "held"))
    rate, full = 0.0, -1
    while True:
        whole = F.col("share") * F.lit(rate) >= F.col("held")
        now, taken, left = shares.agg(F.count_if(whole), F.sum(F.when(whole, F.col("held"))), F.sum(F.when(~whole, F.col("share")))).first()
        if now == full or not left:
            break
        rate, full = float((tokens - (taken or 0.0)) / left), now
    # all whole: the rate that made the last of them so
    return shares.select("value", F.least("held", F.col("share") * F.lit(rate)).alias("target"))


def _filled(cells: DataFrame, column: str, goal: str) -> DataFrame:
    """Cells with their factor changed so that tokens * least(1, factor) adds up to the target, in `goal`, of each of the
    column's values, as far as it has so many tokens; values without a target get factor 0."""
    target = F.col(goal)
    over = Window.partitionBy(column)
    order = over.orderBy(F.desc("factor"))
    mass = F.col("tokens") * F.col("factor")
    upto = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.coalesce(F.sum(mass).over(order.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0))
    # what the value gives when this cell is just whole
    gives = F.when(F.col("factor") > 0, upto + after / F.col("factor"))
    cells = cells.withColumn("whole", F.coalesce(gives <= target, F.lit(False)))
    held = F.coalesce(F.sum(F.when(F.col("whole"), F.col("tokens"))).over(over), F.lit(0))
    free = F.sum(F.when(~F.col("whole"), mass)).over(over)
    least = F.min(F.when(F.col("factor") > 0, F.col("factor"))).over(over)
    lifted = F.when(least < 1, F.lit(WHOLE) / least).otherwise(1.0)
    by = F.coalesce(F.when(target.isNotNull(), F.when(free > 0, (target - held) / free).otherwise(lifted)), F.lit(0.0))
    was, new = F.least(F.lit(1.0), "factor"), F.least(F.lit(1.0), F.col("factor") * F.col("by"))
    moved = F.greatest("moved", F.when((F.col("tokens") > 0) & (was > 0), F.abs(new / was - 1)).otherwise(0.0))
    cells = cells.withColumn("by", by).withColumn("moved", moved).withColumn("factor", F.col("factor") * F.col("by"))
    return cells.drop("whole", "by")


def fit(
    cells: DataFrame,
    targets: dict[str, DataFrame],
    tolerance: float = TOLERANCE,
    sweeps: int = SWEEPS,
    tokens: float | None = None,
) -> DataFrame:
    """`cells` with `factor`: tokens * factor has, summed over each column in `targets`, that column's target shares.

    With `tokens`, factors are probabilities where they are below 1, and 1 stands for all above: so many tokens are dealt
    out by the shares, a cell that would give more than it has is whole, and the rest is fitted to what is left. A value
    with fewer tokens than its share is whole too, and the others of its column make up for it.

    Marginals that the cells can't meet together leave the last column exact and the rest as near as `sweeps` sweeps
    came; `moved` tells by how much the last sweep still changed a cell, and a warning says so.
    """
    goals: dict[str, str] = {}
    if tokens is None:
        targets = {column: _normalized(cells, column, table) for column, table in targets.items()}
        cells = checkpointed(cells.withColumns({"factor": F.lit(1.0), "moved": F.lit(0.0)}))
        change = _rescaled
    else:
        cells = _wanted(cells, targets)
        most = cells.agg(F.sum(F.col("tokens") * F.col("factor"))).first()[0] or 0.0
        targets = {column: _tokens_of(cells, column, table, min(tokens, most)) for column, table in targets.items()}
        for column, table in targets.items():
            goals[column] = fresh(cells, f"goal_{column}")
            named = checkpointed(table).withColumnRenamed("target", goals[column])
            cells = cells.join(named, F.expr(f"`{column}` <=> value"), "left").drop("value")
        # the targets go with the cells, so that a sweep has no join
        cells, targets, change = checkpointed(cells), goals, _filled
    for _ in range(sweeps):
        cells = cells.withColumn("moved", F.lit(0.0))
        cells = checkpointed(reduce(lambda c, item: change(c, *item), targets.items(), cells))
        moved = cells.agg(F.max("moved")).first()[0] or 0.0
        if moved <= tolerance:
            break
    else:
        warnings.warn(f"targets contradict each other: the last of {sweeps} sweeps moved a cell by {moved:.2g}", stacklevel=2)
    return cells.drop(*goals.values())


def uniform(doc_id: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on doc_id and seed alone."""
    name = F.concat(F.lit(seed), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mixed(
    docs: DataFrame,
    temper: dict[str, float] | None = None,
    targets: dict[str, DataFrame] | None = None,
    tokens: float | None = None,
    seed: str = SEED,
    share: float | None = SHARE,
) -> DataFrame:
    """For every row doc_id, source, lang, topic, n_tokens, probability and sampled.

    Targets are tables (value, share) by column, by default the corpus' own shares tempered by `temper`. About `tokens`
    are drawn, or `share` of all the corpus' tokens, fewer only if those with a target are fewer. Cells that would have
    to give more than they have are whole, and the rest is fitted to what is left, so a rare value changes next to
    nothing for others. With neither (share=None), the likeliest cell has probability 1: the largest sample that has the
    target shares exactly, but the rarest cell decides how large that is.

    Null is a value like others in source and lang. A null text is empty: it weighs nothing, as do all texts without
    a word, and values that hold only such documents aren't drawn. Repeated rows are drawn or left together. Other
    columns aren't read; an empty table gives an empty one.
    """
    rows = docs.select(
        "doc_id", "source", "lang", topic_of(F.col("text")).alias("topic"), token_weight(F.col("text")).alias("n_tokens")
    )
    return _drawn(rows, temper or TEMPER, targets, tokens, seed, share)


def _drawn(
    rows: DataFrame, temper: dict, targets: dict | None, tokens: float | None, seed: str, share: float | None
) -> DataFrame:
    columns = ["source", "lang", "topic"]
    cells = checkpointed(rows.groupBy(*columns).agg(F.sum("n_tokens").alias("tokens")))
    targets = targets or {c: checkpointed(tempered_targets(cells, c, temper[c])) for c in columns}
    if tokens is None and share is not None:
        tokens = share * (cells.agg(F.sum("tokens")).first()[0] or 0)
    cells = fit(cells, targets, tokens=tokens)
    count, most = cells.agg(F.count("*"), F.max(F.when(F.col("tokens") > 0, F.col("factor")))).first()
    scale = (1 / most if tokens is None else 1.0) if most else 0.0
    chances = cells.select(*[F.col(c).alias(f"c_{c}") for c in columns], F.least(F.lit(1.0), F.col("factor") * F.lit(scale)).alias("p"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in columns))
    out = rows.join(if_small(chances, count), same, "left")
    p = F.round("p", 9)
    drawn = uniform(F.col("doc_id"), seed) < p
    kept = [c for c in rows.columns if c != "n_tokens"]
    return out.select(*[F.col(f"`{c}`") for c in kept], "n_tokens", p.alias("probability"), drawn.alias("sampled"))


def mixture(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of `docs`, with their columns, that mixed() draws."""
    parts = {"temper": TEMPER, "targets": None, "tokens": None, "seed": SEED, "share": SHARE, **parameters}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    topic, weight = topic_of(F.col("text")).alias("topic"), token_weight(F.col("text")).alias("n_tokens")
    rows = docs.select(row, "doc_id", "source", "lang", topic, weight)
    return _drawn(rows, **parts).where("sampled").select("row.*")
