"""Near-duplicate groups by bottom-k sketches from one hash function.

Every text becomes the set of hashes of its word shingles; the k smallest hashes are its sketch. Texts with equal
sets form one class first, so copies cost one row each and never meet in pairs. Of every class, the rarest sketch
values go into inverted lists: two sets as similar as asked share at least `floor` sketch values, so they share one of
the rarest `k - floor + 1` (the prefix filter). Values that boilerplate carries into many sketches come last in that
order and rarely get into a list.

Short lists emit their pairs. A long list doesn't: its members are compared with one pivot, the member with the most
common values. Two members of the list then either share a value that the pivot hasn't, and meet in a list of their
values beside the pivot's, which are rare; or all that they share is the pivot's too, so that each shares as much
with the pivot, and they meet by size, if neither is linked with the pivot anyway. Lists that are still long get
another pivot, until the pairs in them are no more than the rows of the first lists; then all pairs are emitted that
links found so far don't connect, so no link is lost. A pivot has nothing beside its own values, so lists only shrink.
A pair is dropped if the sketch of the union has fewer than `floor` values in common, else its full sets decide.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import checkpointed, fresh, if_small, materialize, white_words
from headway.llm.components import stars

#: Values of a sketch.
SKETCH = 64
#: Chance that a linked pair of large sets shares fewer sketch values than the floor asks for.
MISS = 1e-9
#: Longer lists are taken apart by pivots.
SHORT_LIST = 16


def overlap_floor(k: int, percent: int, miss: float = MISS) -> int:
    """The largest c so that a pair of that similarity has under c of the union's k smallest values in common
    with a chance of at most `miss` (binomial, which bounds drawing without replacement)."""
    p, below, c = percent / 100, 0.0, 0
    while c < k and (below := below + comb(k, c) * p**c * (1 - p) ** (k - c)) <= miss:
        c += 1
    return c


def shingle_set(text: Column, words: int) -> Column:
    """The distinct 64-bit hashes of all runs of `words` words, sorted; shorter texts are one run, empty texts none."""

    def runs(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - words)
        each = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(words)]))
        short = F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
        return F.sort_array(F.array_distinct(F.when(F.size(hashes) >= words, each).otherwise(short)))

    hashed = F.transform(white_words(text), lambda w: F.xxhash64(w))
    # bound as a lambda variable, the hashes are computed once a row; known not to be null, the set isn't computed in a
    # filter for nulls, which would come before the joins that choose texts
    return F.coalesce(F.get(F.transform(F.array(hashed), runs), F.lit(0)), F.array().cast("array<bigint>"))


def _keyed(docs: DataFrame, words: int) -> DataFrame:
    """id, text's set, its size n, and a 128-bit key (p, q) that is equal for equal sets."""
    sets = docs.select(F.col("doc_id").alias("id"), shingle_set(F.col("text"), words).alias("set"))
    return sets.select(
        "id",
        "set",
        F.size("set").cast("long").alias("n"),
        F.xxhash64("set").alias("p"),
        F.xxhash64(F.lit(words), "set").alias("q"),
    )


def _rarest(values: DataFrame, held: Column, need: Column) -> DataFrame:
    """Of rows (ctx, v, cid, ...), those of values that meet another class in their context and are among a class'
    `held - need + 1` rarest; w is how common the class' values are together."""
    common = values.groupBy("ctx", "v").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("ctx", "cid")
    shared = values.join(common, ["ctx", "v"]).withColumn("alone", held - F.count("*").over(own))
    shared = shared.withColumn("w", F.sum("df").over(own))
    turn = F.row_number().over(own.orderBy("df", "v")) + F.col("alone")
    return shared.withColumn("turn", turn).where(F.col("turn") <= held - need + 1).select("ctx", "v", "cid", "n", "w")


def _first_lists(classes: DataFrame, k: int, percent: int, floor: int) -> DataFrame:
    """Inverted lists (ctx, v, cid, n, w) over the rarest values of every sketch, in one context."""
    values = classes.select(F.lit(0).cast("long").alias("ctx"), "cid", "n", F.explode("sketch").alias("v"))
    need = F.ceil(F.col("n") * percent / 100)
    need = F.when(F.col("n") * 100 <= k * percent, need).otherwise(F.least(need, F.lit(floor)))
    return _rarest(values, F.least(F.col("n"), F.lit(k)), need)


def _similar_sizes(x: str, y: str, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """`rows` with the component of cid, as far as it is known."""
    out = rows.join(labels.select("cid", F.col("root").alias("label")), "cid", "left")
    return out.withColumn("label", F.coalesce("label", "cid"))


def _by_length(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ctx, v, lead, size) of the short and the long lists; lead is the member with the most common values."""
    lead = F.max_by("cid", F.struct("w", "cid")).alias("lead")
    found = lists.groupBy("ctx", "v").agg(F.count("*").alias("size"), lead)
    found = checkpointed(found.where("size > 1"))
    return found.where(F.col("size") <= SHORT_LIST), found.where(F.col("size") > SHORT_LIST)


def _cross_pairs(some: DataFrame, all_: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Distinct pairs of a row in `some` and one in `all_` with equal keys, other labels and the condition on both."""
    left = some.select(*keys, F.col("cid").alias("x"), F.col("n").alias("xn"), F.col("label").alias("xl"), *_more(some))
    return left.join(all_, keys).where((F.col("xl") != F.col("label")) & condition).select(*_pair("x", "cid")).distinct()


def _more(rows: DataFrame) -> list[Column]:
    return [F.col(c).alias(f"x{c}") for c in ("parts", "set") if c in rows.columns]


def _only(sets: DataFrame, ids: DataFrame, classes: int) -> DataFrame:
    """The sets of the classes in the one column of `ids`, so that a join shuffles no others; there are `classes` sets."""
    wanted = ids.toDF("wanted").distinct()
    return sets.join(if_small(wanted, classes), F.col("cid") == F.col("wanted"), "left_semi")


def _beside_main(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose label isn't the most frequent one of their keys."""
    parts = rows.groupBy(*keys, "label").agg(F.count("*").alias("rows"))
    main = parts.groupBy(*keys).agg(F.max_by("label", F.struct("rows", "label")).alias("main"), F.count("*").alias("kinds"))
    return rows.join(main.where("kinds > 1"), keys).where("label <> main").drop("main", "kinds")


def _members(lists: DataFrame, long: DataFrame, before: DataFrame | None, sets: DataFrame, count: int) -> DataFrame:
    """(ctx, cid, n, lead, rest, parts): the members of long lists in the context of their pivot, with what neither this
    nor an earlier pivot of theirs holds, and how many of their values each pivot took in turn."""
    hung = lists.join(long.select("ctx", "v", "lead"), ["ctx", "v"]).select("ctx", "cid", "n", "lead").distinct()
    if before is None:
        whole = _only(sets, hung.select("cid"), count)
        hung = hung.join(whole.select("cid", F.col("set").alias("rest"), F.array().cast("array<int>").alias("parts")), "cid")
    else:
        hung = hung.join(before.select("ctx", "cid", "rest", "parts"), ["ctx", "cid"])
    pivots = _only(sets, long.select("lead"), count).select(F.col("cid").alias("lead"), F.col("set").alias("taken"))
    out = hung.join(pivots, "lead").withColumn("left", F.array_except("rest", "taken"))
    parts = F.concat("parts", F.array(F.size("rest") - F.size("left"))).alias("parts")
    out = out.select(F.xxhash64("ctx", "lead").alias("ctx"), "cid", "n", "lead", F.col("left").alias("rest"), parts)
    return materialize(out, "members")


def _rest_lists(members: DataFrame, percent: int) -> DataFrame:
    """Lists of the values beside the pivots'. Where pivots hold too little of a class for a link, the rest must have
    what is missing, so its rarest values suffice."""
    size = F.size("rest").cast("long").alias("size")
    values = members.select("ctx", "cid", "n", size, F.explode("rest").alias("v"))
    missing = F.greatest(F.ceil(F.col("n") * percent / 100) - (F.col("n") - F.col("size")), F.lit(1))
    return _rarest(values, F.col("size"), missing)


def _alike(x: str, y: str, percent: int) -> Column:
    """100 * both >= percent * union, with the intersection in it once: Spark computes what a condition holds twice before
    all of the condition, so for every pair, also where an earlier test fails."""
    return F.size(F.array_intersect(x, y)).cast("long") * (100 + percent) >= (F.size(x) + F.size(y)) * percent


def _linked_within_pivots(members: DataFrame, labels: DataFrame, sets: DataFrame, count: int, percent: int) -> DataFrame:
    """Links (a, b) of pairs that their pivots' values alone can link. Of what a pivot took, a pair shares at most the
    smaller number; these must add up to what a linked pair shares. The full sets go into the join, so that the pairs
    which pass that test, but aren't linked, never become rows."""
    held = F.col("n") - F.size("rest")
    covered = members.where(held * 100 >= F.col("n") * percent).select("ctx", "cid", "n", "parts")
    covered = _labelled(covered, labels).join(_only(sets, covered.select("cid"), count), "cid")
    # sizes that can be linked are in neighbouring bands
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    banded = covered.withColumn("band", band)
    beside = _beside_main(covered, ["ctx"]).withColumn("band", F.explode(F.array(band - 1, band, band + 1)))
    most = F.aggregate(F.zip_with("xparts", "parts", lambda x, y: F.least(x, y)), F.lit(0), lambda a, x: a + x)
    enough = most * (100 + percent) >= (F.col("xn") + F.col("n")) * percent
    tests = _similar_sizes("xn", "n", percent) & enough & _alike("xset", "set", percent)
    return _cross_pairs(beside, banded, ["ctx", "band"], tests)


def _links(pairs: DataFrame, classes: DataFrame, sets: DataFrame, count: int, k: int, percent: int, floor: int) -> DataFrame:
    """The pairs whose full sets are similar enough: sketches of the union first, exact Jaccard for what is left."""

    def side(rows: DataFrame, name: str, value: str) -> DataFrame:
        return rows.select(F.col("cid").alias(name), F.col(value).alias(f"s{name}"))

    met = pairs.join(side(classes, "a", "sketch"), "a").join(side(classes, "b", "sketch"), "b")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    whole = (F.size("sa") < k) & (F.size("sb") < k)
    near = met.where(F.when(whole, _alike("sa", "sb", percent)).otherwise(shared >= floor)).select("a", "b")
    near = checkpointed(near)
    left, right = (side(_only(sets, near.select(end), count), end, "set") for end in ("a", "b"))
    full = near.join(left, "a").join(right, "b")
    return full.where(_alike("sa", "sb", percent)).select("a", "b")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, k: int = SKETCH, miss: float = MISS, pivots: int | None = None
) -> DataFrame:
    """Groups of documents with 100 * intersection >= percent * union of their distinct word shingles.

    Takes doc_id and text; other columns are ignored, whatever their names. Returns, for every row, doc_id,
    n_shingles, component_id (the smallest doc_id linked with it, directly or over others) and kept (it is that one).
    A null or blank text has no shingle and no link. Rows with a null doc_id take part; they don't name a component,
    and aren't kept; a component without any doc_id is null. Repeated rows come back as often as they came. A very long
    text is one row with its set of hashes. An empty table gives an empty one.

    `pivots` is how often long lists are taken apart; None takes as many as their pairs ask for. The result is the same.
    Two sets are equal if their 128-bit keys are, and shingles if their 64-bit hashes are. A linked pair of sets of over
    `k` shingles is missed with a chance of at most `miss`, where its sketches have too few values in common by chance.
    """
    floor = overlap_floor(k, percent, miss)
    keyed = _keyed(docs, words)
    marks = materialize(keyed.select("id", "n", "p", "q", F.slice("set", 1, k).alias("sketch")), "sketches")
    grouped = marks.where("n > 0").groupBy("n", "p", "q").agg(F.min("id").alias("id"), F.first("sketch").alias("sketch"))
    classes = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    lists = materialize(_first_lists(classes, k, percent, floor), "lists")

    met = classes.join(lists.select("cid").distinct(), "cid", "left_semi").select("id", "n", "p", "q", "cid")
    met = checkpointed(met)
    count = met.count()
    ids = met.select(F.col("id").alias("wanted")).distinct()
    texts = docs.select("doc_id", "text").join(if_small(ids, count), F.expr("doc_id <=> wanted"), "left_semi")
    sets = _keyed(texts, words).select("n", "p", "q", "set").join(met.select("n", "p", "q", "cid"), ["n", "p", "q"])
    sets = materialize(sets.groupBy("cid").agg(F.first("set").alias("set")), "sets")
    sketches = checkpointed(classes.join(met.select("cid"), "cid", "left_semi").select("cid", "sketch"))

    links = docs.sparkSession.createDataFrame([], "a bigint, b bigint")
    labels = links.select(F.col("a").alias("cid"), F.col("b").alias("root"))
    members, room, round_ = None, lists.count(), 0
    more = True
    while more:
        short, long = _by_length(lists)
        left = long.agg(F.sum(F.col("size") * F.col("size"))).first()[0] or 0
        more = left > room if pivots is None else round_ < pivots
        round_ += 1
        rows = _labelled(lists, labels)
        alike = _similar_sizes("xn", "n", percent)
        few = rows.join(short.select("ctx", "v"), ["ctx", "v"])
        pairs = _cross_pairs(few, few.select(*few.columns), ["ctx", "v"], (F.col("x") < F.col("cid")) & alike)
        within = links.limit(0) if members is None else _linked_within_pivots(members, labels, sets, count, percent)
        many = rows.join(long.select("ctx", "v"), ["ctx", "v"])
        if more:
            members = _members(lists, long, members, sets, count)
            pairs = pairs.union(members.where("cid <> lead").select(*_pair("cid", "lead")))
            lists = materialize(_rest_lists(members, percent), "lists")
        else:
            pairs = pairs.union(_cross_pairs(_beside_main(many, ["ctx", "v"]), many, ["ctx", "v"], alike))
        found = _links(pairs.distinct(), sketches, sets, count, k, percent, floor).union(within)
        links = checkpointed(links.union(found.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        links = stars(links)
        labels = links.select(F.col("a").alias("cid"), F.col("b").alias("root"))

    rooted = classes.select("cid", "id", "n", "p", "q").join(labels, "cid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cid"))
    named = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    out_keys = rooted.join(named, "root").select("n", "p", "q", "component_id")
    out = marks.select("id", "n", "p", "q").join(out_keys, ["n", "p", "q"], "left")
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of `docs`, with all their columns, of the one document kept of each group.

    Rows of one doc_id stay if any of them is kept; of those with the same text, one stays. Rows without a doc_id have
    nothing to be named by and stay.
    """
    groups = near_duplicates(docs, **parameters).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone_id, again_id = fresh(docs, "gone_id"), fresh(docs, "again_id")
    gone = checkpointed(groups.where("not kept and doc_id is not null").select(F.col("doc_id").alias(gone_id)))
    repeated = docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null")
    repeated = checkpointed(repeated.select(F.col("doc_id").alias(again_id)))
    out = docs.join(if_small(gone, gone.count()), F.col("doc_id") == F.col(gone_id), "left_anti")
    again, same = if_small(repeated, repeated.count()), F.col("doc_id") == F.col(again_id)
    copies = out.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return out.join(again, same, "left_anti").unionByName(copies)
