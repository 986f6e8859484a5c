"""Product quantization of vectors by dual-tree Lloyd iterations, in whole numbers.

Vectors stay in blocks as they are read. In a block, every part position has a balanced tree over its parts, with the
bounding box, the count and the componentwise sum of each node; it is built once and stored. Every round has a tree
over a codebook's entries too. Both are descended together: of a pair of nodes the least and the largest squared
distance between their boxes are known, so entries that can't be nearest to anything of a node drop out, a node that one
entry is left for is assigned whole by its cached sum, and only what is uncertain at the leaves is compared part by
part. All bounds and distances are integers, hence exact, and ties go to the lower entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from headway.llm.common import checkpointed, if_small
from headway.llm.vectors import usable

#: Vectors of a block and at most so many numbers in it.
BLOCK_ROWS, BLOCK_NUMBERS = 4096, 1 << 19
#: Parts of a leaf at most.
LEAF = 32
#: Components of n-dimensional vectors beyond this over the root of n could make squares of more than 64 bits.
LARGEST = 1 << 30
#: Uncertain parts compared at once.
COMPARED = 1 << 15


def _spans(n: int, depth: int) -> np.ndarray:
    """Where the 2**depth nodes of a level begin, and the end."""
    return (n * np.arange((1 << depth) + 1)) >> depth


def _depth(n: int, leaf: int) -> int:
    depth = 0
    while -(-n >> depth) > leaf:
        depth += 1
    return depth


class Tree:
    """A balanced tree over the rows of a matrix: every node is halved across its widest side, and node k of a level has the
    nodes 2k and 2k+1 of the next. `rows` are in the order of the leaves."""

    def __init__(self, rows: np.ndarray, order: np.ndarray, depth: int, boxes: np.ndarray):
        self.rows, self.order, self.depth, self.boxes = rows, order, depth, boxes

    @classmethod
    def over(cls, rows: np.ndarray, leaf: int = LEAF) -> Tree:
        n, depth = len(rows), _depth(len(rows), leaf)
        order = np.arange(n, dtype=np.int32)
        for level in range(depth):
            starts = _spans(n, level)
            now = rows[order]
            wide = np.maximum.reduceat(now, starts[:-1]) - np.minimum.reduceat(now, starts[:-1])
            node = np.repeat(np.arange(1 << level), np.diff(starts))
            order = order[np.lexsort((now[np.arange(n), wide.argmax(axis=1)[node]], node))]
        now = rows[order]
        levels = []
        for level in range(depth + 1):
            at = _spans(n, level)[:-1]
            levels.append(np.stack([f.reduceat(now, at) for f in (np.minimum, np.maximum, np.add)]))
        return cls(now, order, depth, np.concatenate(levels, axis=1))

    def nodes(self, level: int) -> np.ndarray:
        """Least and largest components and sums of a level's nodes, as (3, nodes, width)."""
        return self.boxes[:, (1 << level) - 1 : (2 << level) - 1]


def _gaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distances between boxes: of each of a (3, m, w) to each of its row of b (3, m, k, w)."""
    low, high = a[0][:, None], a[1][:, None]
    near = np.maximum(0, np.maximum(low - b[1], b[0] - high))
    far = np.maximum(high - b[0], b[1] - low)
    return (near * near).sum(axis=-1), (far * far).sum(axis=-1)


def _outranked(boxes: np.ndarray, entries: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Which of the entries left for a node lose everywhere in its box to the entry nearest to the box' middle. The
    difference of two squared distances is linear, so its least value over a box is at a corner."""
    low, high = boxes[0][:, None], boxes[1][:, None]
    twice = (2 * entries[None] - low - high) ** 2
    best = np.where(left, twice.sum(axis=-1), np.iinfo(np.int64).max).argmin(axis=1)
    slope = 2 * (entries[best][:, None] - entries[None])
    least = np.where(slope > 0, slope * low, slope * high).sum(axis=-1)
    squares = (entries * entries).sum(axis=-1)
    least += squares[None] - squares[best][:, None]
    later = np.arange(len(entries))[None] > best[:, None]
    return (least > 0) | ((least == 0) & later)


def assign(tree: Tree, entries: np.ndarray, whole, single) -> None:
    """Deals all parts to their nearest entries: calls whole(level, nodes, entry) for nodes that go to one entry as they are
    and single(places, entry) for parts compared one by one; places are positions in the tree's order."""
    k = len(entries)
    guide = Tree.over(entries, leaf=1)
    spread = guide.depth
    nodes, pairs = np.zeros(1, np.int64), np.ones((1, 1), bool)
    for level in range(tree.depth + 1):
        mine = tree.nodes(level)[:, nodes]
        deep = min(level, spread)
        theirs = np.broadcast_to(guide.nodes(deep)[:, None], (3, len(nodes), 1 << deep, entries.shape[1]))
        near, far = _gaps(mine, theirs)
        far = np.where(pairs, far, np.iinfo(np.int64).max)
        pairs = pairs & (near <= far.min(axis=1)[:, None])
        if deep == spread:
            starts = _spans(k, spread)
            held = np.zeros((len(nodes), k), bool)  # by entry; a guide of k entries has a leaf for each, some empty
            for leaf in range(1 << spread):
                held[:, guide.order[starts[leaf] : starts[leaf + 1]]] = pairs[:, leaf : leaf + 1]
            held &= ~_outranked(mine, entries, held)
            certain = held.sum(axis=1) == 1
            if certain.any():
                whole(level, nodes[certain], held[certain].argmax(axis=1))
            nodes, pairs, held = nodes[~certain], pairs[~certain], held[~certain]
            if level == tree.depth:
                break
        elif level == tree.depth:
            held = np.ones((len(nodes), k), bool)
            break
        if not len(nodes):
            return
        nodes, pairs = np.stack([2 * nodes, 2 * nodes + 1], axis=1).reshape(-1), np.repeat(pairs, 2, axis=0)
        if deep < spread:
            pairs = np.repeat(pairs, 2, axis=1)
    starts = _spans(len(tree.rows), tree.depth)
    begin, size = starts[nodes], starts[nodes + 1] - starts[nodes]
    owner = np.repeat(np.arange(len(nodes)), size)
    places = np.arange(len(owner)) + np.repeat(begin - (np.cumsum(size) - size), size)
    for at in range(0, len(places), COMPARED):
        part = slice(at, at + COMPARED)
        away = tree.rows[places[part]][:, None] - entries[None]
        away = np.where(held[owner[part]], (away * away).sum(axis=-1), np.iinfo(np.int64).max)
        single(places[part], away.argmin(axis=1))


def sums_by_entry(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Componentwise sums and counts of the parts nearest to each entry."""
    sums, counts = np.zeros_like(entries), np.zeros(len(entries), np.int64)

    def whole(level, nodes, entry):
        np.add.at(sums, entry, tree.nodes(level)[2][nodes])
        np.add.at(counts, entry, np.diff(_spans(len(tree.rows), level))[nodes])

    def single(places, entry):
        np.add.at(sums, entry, tree.rows[places])
        np.add.at(counts, entry, 1)

    assign(tree, entries, whole, single)
    return sums, counts


def nearest_entries(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part's entry and squared distance, in the order of the rows that the tree was made of."""
    found = np.empty(len(tree.rows), np.int64)

    def whole(level, nodes, entry):
        starts = _spans(len(tree.rows), level)
        for node, e in zip(nodes, entry, strict=True):
            found[starts[node] : starts[node + 1]] = e

    def single(places, entry):
        found[places] = entry

    assign(tree, entries, whole, single)
    away = tree.rows - entries[found]
    out = np.empty((2, len(found)), np.int64)
    out[:, tree.order] = found, (away * away).sum(axis=1)
    return out[0], out[1]


def next_entries(entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Componentwise floors of means; an entry without parts stays."""
    return np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], entries)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: blocks are large."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


_STORED = "dim int, ids array<{id}>, labels array<{label}>, nodes array<binary>, rows array<binary>, places array<binary>"


def _block(dim: int, ids: list, labels: list, values: np.ndarray, parts: int, kinds: pa.Schema) -> pa.RecordBatch:
    """One block's trees, as a row."""
    trees = [Tree.over(values[:, p * (dim // parts) : (p + 1) * (dim // parts)]) for p in range(parts)]
    bits = lambda what: [[np.ascontiguousarray(what(t)).tobytes() for t in trees]]
    columns = [[dim], [ids], [labels], bits(lambda t: t.boxes), bits(lambda t: t.rows.astype("<i4")), bits(lambda t: t.order)]
    return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)


def _trees(row: dict, parts: int) -> Iterator[Tree]:
    width = row["dim"] // parts
    for nodes, rows, order in zip(row["nodes"], row["rows"], row["places"], strict=True):
        rows = np.frombuffer(rows, "<i4").reshape(-1, width).astype(np.int64)
        boxes = np.frombuffer(nodes, "<i8").reshape(3, -1, width)
        yield Tree(rows, np.frombuffer(order, "<i4"), (boxes.shape[1] + 1).bit_length() - 2, boxes)


def blocks(scaled: DataFrame, parts: int) -> DataFrame:
    """The stored blocks of (id, label, v): each task cuts its own rows, so nothing is shuffled."""
    names = {"id": scaled.schema["id"].dataType.simpleString(), "label": scaled.schema["label"].dataType.simpleString()}
    schema = _STORED.format(**names)
    id_type, label_type = (to_arrow_type(scaled.schema[c].dataType) for c in ("id", "label"))
    blobs = pa.list_(pa.binary())
    kinds = pa.schema({"dim": pa.int32(), "ids": pa.list_(id_type), "labels": pa.list_(label_type), "nodes": blobs, "rows": blobs, "places": blobs})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list, list]] = {}

        def made(dim: int) -> pa.RecordBatch:
            ids, labels, vectors = held.pop(dim)
            return _block(dim, ids, labels, np.concatenate(vectors), parts, kinds)

        for batch in batches:
            lists = batch.column("v")
            sizes = np.asarray(lists.value_lengths())
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            ids, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
            for dim in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == dim)
                most = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // dim))
                while len(mine):
                    some = held.setdefault(dim, ([], [], []))
                    now, mine = mine[: most - len(some[0])], mine[most - len(some[0]) :]
                    some[0].extend(ids[i] for i in now)
                    some[1].extend(labels[i] for i in now)
                    some[2].append(values[(ends[now] - dim)[:, None] + np.arange(dim)])
                    if len(some[0]) == most:
                        yield made(dim)
        for dim in list(held):
            yield made(dim)

    return scaled.select("id", "label", "v").mapInArrow(cut, schema)


def _first_entries(scaled: DataFrame, stored: DataFrame, parts: int, entries: int) -> dict[int, np.ndarray]:
    """Per length, the vectors of the smallest ids as (parts, entries, width). A model, whose size the data doesn't change:
    `entries` rows for each length of vectors that occurs."""
    id_type = scaled.schema["id"].dataType

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}
        for row in _rows(batches):
            new = {i for i in row["ids"] if i is not None}
            kept[row["dim"]] = nsmallest(entries, new.union(kept.get(row["dim"], ())))
        for dim, ids in kept.items():
            columns = [pa.array([dim] * len(ids), pa.int32()), pa.array(ids, to_arrow_type(id_type))]
            yield pa.RecordBatch.from_arrays(columns, names=["dim", "id"])

    of_tasks = stored.select("dim", "ids").mapInArrow(least, f"dim int, id {id_type.simpleString()}").distinct()
    ranked = of_tasks.withColumn("nth", F.row_number().over(Window.partitionBy("dim").orderBy("id")))
    first = ranked.where(F.col("nth") <= entries).select("dim", "id")
    sized = scaled.where("id IS NOT NULL").withColumn("dim", F.size("v"))
    found: dict[int, list] = {}
    for row in sized.join(F.broadcast(first), ["dim", "id"]).groupBy("dim", "id").agg(F.min("v").alias("v")).orderBy("dim", "id").collect():
        found.setdefault(row.dim, []).append(row.v)
    return {dim: np.array(v, np.int64).reshape(len(v), parts, -1).swapaxes(0, 1).copy() for dim, v in found.items()}


def _round(stored: DataFrame, books: dict[int, np.ndarray], parts: int) -> dict[int, np.ndarray]:
    """The codebooks after one round. A task adds up its blocks before anything is shuffled."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for row in _rows(batches):
            book = books.get(row["dim"])
            if book is not None:
                both = [sums_by_entry(t, book[p]) for p, t in enumerate(_trees(row, parts))]
                new = np.array([np.column_stack(b) for b in both]).reshape(-1)
                totals[row["dim"]] = new + totals.get(row["dim"], 0)
        for dim, values in totals.items():
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "v": pa.array([values], pa.list_(pa.int64()))})

    summed = stored.select("dim", "nodes", "rows", "places").mapInArrow(add, "dim int, v array<bigint>")
    summed = summed.select("dim", F.posexplode("v").alias("at", "x")).groupBy("dim", "at").agg(F.sum("x").alias("x"))
    new = {dim: np.zeros((*book.shape[:2], book.shape[2] + 1), np.int64) for dim, book in books.items()}
    for row in summed.collect():  # one number per component of the codebooks
        new[row.dim].reshape(-1)[row["at"]] = row.x
    return {dim: next_entries(book, new[dim][..., :-1], new[dim][..., -1]) for dim, book in books.items()}


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def scaled_vectors(vectors: DataFrame, id: str, vector: str, label: str, parts: int, scale: int) -> DataFrame:
    """(id, label, v): the rows that take part, their components as whole numbers."""
    exact = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    most = F.lit(LARGEST / scale) / F.sqrt(F.size(vector))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double")) <= most)
    told = F.raise_error(F.concat(F.lit("too large a component in the vector "), F.coalesce(F.col(id).cast("string"), F.lit("without id"))))
    rows = vectors.where(usable(F.col(vector)) & (F.size(vector) % parts == 0))
    whole: Column = F.when(fits, F.transform(vector, exact)).otherwise(told.cast("array<bigint>"))
    return rows.select(F.col(id).alias("id"), F.col(label).alias("label"), whole.alias("v"))


def compressed(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """Codes of all vectors, and the codebooks: by vector length, (parts, entries, width) whole numbers.

    The first gives each row's id, `code` (two hex digits a part), `error` (squared distance to the coded vector, in whole
    numbers), `label_error` (errors summed over equal labels, nulls together) and `codebooks_sha256`.

    Rows whose vector is null, empty, or holds a null or non-finite component don't take part, nor do those that can't be
    cut into `parts` equal parts. Vectors of every length have codebooks of their own, which begin as the vectors with that length's
    `entries` smallest ids (fewer if there are fewer; of an id that repeats, the smallest vector). A null id takes part, but begins
    no codebook; a length without any id has no codebook, and its rows don't take part. Repeated rows are coded one for one. Components too large
    for exact 64-bit sums raise an error that names the row. Ties go to the lower entry; an entry without parts stays. Without rows both results are empty.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits")
    scaled = scaled_vectors(vectors, id, vector, label, parts, scale)
    stored = checkpointed(blocks(scaled, parts))
    books = _first_entries(scaled, stored, parts, entries)
    for _ in range(rounds):
        books = _round(stored, books, parts)
    names = {dim: digest(book) for dim, book in books.items()}
    id_type, label_type = (scaled.schema[c].dataType for c in ("id", "label"))
    kinds = (to_arrow_type(id_type), to_arrow_type(label_type))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexes = np.array([f"{e:02x}" for e in range(entries)])
        for row in _rows(batches):
            if row["dim"] in books:
                found = [nearest_entries(t, books[row["dim"]][p]) for p, t in enumerate(_trees(row, parts))]
                codes = ["".join(x) for x in np.stack([hexes[e] for e, _ in found], axis=1)]
                columns = [pa.array(row["ids"], kinds[0]), pa.array(row["labels"], kinds[1]), pa.array(codes)]
                columns += pa.array(sum(d for _, d in found)), pa.array([names[row["dim"]]] * len(codes))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error", "codebooks_sha256"])

    schema = f"id {id_type.simpleString()}, label {label_type.simpleString()}, code string, error bigint, codebooks_sha256 string"
    coded = checkpointed(stored.mapInArrow(code, schema))
    by_label = checkpointed(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    both = coded.join(if_small(by_label, by_label.count()), F.col("label").eqNullSafe(F.col("of")))
    out = both.select(F.col("id").alias(id), "code", "error", "label_error", "codebooks_sha256")
    return out, books
