"""Token-id files in patched frame-of-reference blocks.

A file is a run of pages and a table of its documents. Of a page, every block of 128 ids has its smallest id as base and
a width at which a percentile of its differences from the base fits, the cheapest of a few; differences are packed at
that width, and the high bits of those that don't fit stand in the block's exception list. The page's index has the start of every block
and of its exceptions, so a block can be read alone.

    page:     ids u32, then per block: base u32, start u32, first exception u32, width u8
              the packed blocks (little-endian 64-bit words), exception count u32, their places u8 and high bits u32
    table:    per page: offset u64, first id u64; per document: id i64, has id u8, ids u64
    trailer:  offset of the table u64, pages u64, documents u64, ids u64, magic
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import compress, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.bpe import WORD_END, text_sizes
from headway.llm.common import checkpointed, scratch_dir
from headway.llm.memory import Memory, slices

BLOCK = 128
#: Percentiles of a block's differences, one of which gives its width.
PERCENTILES = (80, 90, 95, 100)
#: Bits of an exception.
EXCEPTION = 40
#: Ids of a page.
PAGE = BLOCK * 2048
#: Bytes of texts encoded at once, or one longer text.
TOGETHER = 4 << 20
#: Bytes of runs remembered by a Python worker, and runs asked for as one text.
ROOM, ASKED = 96 << 20, 512
#: The last letter of a word and the marks up to the next blank, which are tokens of their own. Letters of which the
#: normalizer makes letters again: others could leave an accent, which would stay with the marks.
MARKS = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?]+(?: |$))"
#: Rows of a batch of results.
ROWS = 4096
MAGIC = b"PFORIDS1"
_TRAILER = "<QQQQ8s"
_BLOCK_INDEX = np.dtype([("base", "<u4"), ("start", "<u4"), ("except", "<u4"), ("width", "u1")])


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64 numbers under 2**width as rows of `width` 64-bit words."""
    words = np.zeros((width, len(rows)), np.uint64)
    for i, column in enumerate(np.ascontiguousarray(rows.T).astype(np.uint64)):
        word, bit = divmod(i * width, 64)
        words[word] |= column << np.uint64(bit)
        if bit + width > 64:
            words[word + 1] |= column >> np.uint64(64 - bit)
    return words.T


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """What _pack() got."""
    words, mask = np.ascontiguousarray(words.T), np.uint64((1 << width) - 1)
    out = np.empty((64, words.shape[1]), np.uint64)
    for i in range(64):
        word, bit = divmod(i * width, 64)
        out[i] = words[word] >> np.uint64(bit)
        if bit + width > 64:
            out[i] |= words[word + 1] << np.uint64(64 - bit)
        out[i] &= mask
    return out.T


def _bits(values: np.ndarray) -> np.ndarray:
    """The bits that each number under 2**32 takes."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _widths(over: np.ndarray, percentiles: tuple[int, ...]) -> np.ndarray:
    """For each row, the bits of that percentile which takes the least room together with what exceeds it."""
    ranked = np.sort(over, axis=1)
    options = np.array([_bits(ranked[:, max(0, -(-BLOCK * p // 100) - 1)]) for p in percentiles])
    most = _bits(over)
    room = [w.astype(np.int64) * BLOCK + EXCEPTION * (most > w[:, None]).sum(axis=1) for w in options]
    return np.choose(np.argmin(room, axis=0), options)


def encode_page(ids: np.ndarray, percentiles: tuple[int, ...] = PERCENTILES) -> bytes:
    """One page of at least one unsigned 32-bit id."""
    count, blocks = len(ids), -(-len(ids) // BLOCK)
    grid = np.full(blocks * BLOCK, ids[-1], np.uint32)
    grid[:count] = ids
    grid = grid.reshape(blocks, BLOCK)
    base = grid.min(axis=1)
    over = grid - base[:, None]
    width = _widths(over, percentiles)
    high = over >> np.minimum(width, 31)[:, None].astype(np.uint32)
    high[width == 32] = 0
    at_block, place = np.nonzero(high)
    low = over & ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    index = np.zeros(blocks, _BLOCK_INDEX)
    sizes = width.astype(np.uint32) * (BLOCK // 8)
    index["base"], index["width"] = base, width
    index["start"] = np.cumsum(sizes) - sizes
    index["except"] = np.searchsorted(at_block, np.arange(blocks))
    packed = np.empty(int(sizes.sum()) // 8, "<u8")
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        words = _pack(low[mine].reshape(-1, 64), int(w)).reshape(len(mine), -1)
        packed[(index["start"][mine] // 8)[:, None] + np.arange(words.shape[1])] = words
    lists = place.astype("u1").tobytes() + high[at_block, place].astype("<u4").tobytes()
    return struct.pack("<I", count) + index.tobytes() + packed.tobytes() + struct.pack("<I", len(place)) + lists


def decode_page(page: bytes) -> np.ndarray:
    """The ids of a page."""
    (count,) = struct.unpack_from("<I", page)
    blocks = -(-count // BLOCK)
    index = np.frombuffer(page, _BLOCK_INDEX, blocks, 4)
    at = 4 + index.nbytes
    width = index["width"]
    size = int(width.astype(np.int64).sum()) * (BLOCK // 8)
    packed = np.frombuffer(page[at : at + size], "<u8")
    at += size
    (exceptions,) = struct.unpack_from("<I", page, at)
    place = np.frombuffer(page, "u1", exceptions, at + 4)
    high = np.frombuffer(page[at + 4 + exceptions :], "<u4", exceptions)
    over = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        words = packed[(index["start"][mine] // 8)[:, None] + np.arange(int(w) * BLOCK // 64)]
        over[mine] = _unpack(words.reshape(-1, int(w)), int(w)).reshape(len(mine), BLOCK)
    if exceptions:
        first = index["except"].astype(np.int64)
        block = np.repeat(np.arange(blocks), np.diff(np.append(first, exceptions)))
        over[block, place] |= high << width[block].astype(np.uint32)
    return (over + index["base"][:, None]).reshape(-1)[:count]


class TokenFileWriter:
    """Writes documents' ids, one after another; holds one page at most."""

    def __init__(self, out):
        self.out, self.at, self.held, self.size, self.ids = out, 0, [], 0, 0
        self.pages: list[tuple[int, int]] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids)))
        while len(ids):
            part, ids = ids[: PAGE - self.size], ids[PAGE - self.size :]
            self.held.append(part)
            self.size += len(part)
            if self.size == PAGE:
                self._flush()

    def _flush(self) -> None:
        if self.size:
            page = encode_page(np.concatenate(self.held))
            self.pages.append((self.at, self.ids))
            self.out.write(page)
            self.at, self.ids = self.at + len(page), self.ids + self.size
            self.held, self.size = [], 0

    def close(self) -> None:
        self._flush()
        columns = [*zip(*self.docs, strict=True)] or [(), (), ()]
        self.out.write(np.asarray(self.pages, "<u8").tobytes())
        for values, kind in zip(columns, ("<i8", "u1", "<u8"), strict=True):
            self.out.write(np.asarray(values, kind).tobytes())
        self.out.write(struct.pack(_TRAILER, self.at, len(self.pages), len(self.docs), self.ids, MAGIC))


class TokenFileReader:
    """Reads a file of TokenFileWriter; holds its table and one page."""

    def __init__(self, file):
        size = file.size()
        tail = struct.calcsize(_TRAILER)
        table, pages, docs, self.ids, magic = struct.unpack(_TRAILER, file.read_at(tail, size - tail))
        if magic != MAGIC:
            raise ValueError("not a token file")
        raw = bytes(file.read_at(size - tail - table, table))
        self.file = file
        self.pages = np.frombuffer(raw, "<u8", 2 * pages).reshape(pages, 2).astype(np.int64)
        self.ends = np.append(self.pages[1:, 0], table).astype(np.int64)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 16 * pages)
        self.named = np.frombuffer(raw, "u1", docs, 16 * pages + 8 * docs).astype(bool)
        self.sizes = np.frombuffer(raw[16 * pages + 9 * docs :], "<u8", docs).astype(np.int64)

    def page(self, k: int) -> np.ndarray:
        begin, end = int(self.pages[k, 0]), int(self.ends[k])
        return decode_page(bytes(self.file.read_at(end - begin, begin)))

    def documents(self) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
        """The place of each document and its ids in parts, which must be taken before the next document."""
        page, at, k = np.empty(0, np.uint32), 0, 0

        def parts(left: int) -> Iterator[np.ndarray]:
            nonlocal page, at, k
            while left:
                if at == len(page):
                    page, at, k = self.page(k), 0, k + 1
                part = page[at : at + left]
                at += len(part)
                left -= len(part)
                yield part

        for i, size in enumerate(self.sizes):
            yield i, parts(int(size))


class LibraryIds:
    """Ids of texts by the tokenizers library, asked once for each run of non-space characters that is remembered.
    The file's normalizer and word pattern don't look across white space."""

    def __init__(self, path: str, room: int = ROOM):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.known = Memory(room)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(names.values()) + 1, bool)
        self.ends_word[[i for name, i in names.items() if name.endswith(WORD_END)]] = True

    def _ask(self, runs: list[str]) -> list[bytes]:
        plain = [run.isalpha() for run in runs]
        words = iter(self._ask_words(list(compress(runs, plain))))
        others = iter(self._ask_runs([run for run, p in zip(runs, plain, strict=True) if not p]))
        return [next(words) if p else next(others) for p in plain]

    def _ask_words(self, words: list[str]) -> list[bytes]:
        """The ids of words of letters. Many are asked for as one text; a token that ends a word tells where the next begins."""
        out: list[bytes] = []
        for k in range(0, len(words), ASKED):
            part = words[k : k + ASKED]
            found = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]  # without offsets
            ids = np.asarray(found.ids, "<u4")
            ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(ends) == len(part):
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in pairwise([0, *ends.tolist()])]
            else:  # a letter that is normalized to more than letters
                out += self._ask_runs(part)
        return out

    def _ask_runs(self, runs: list[str]) -> list[bytes]:
        """The ids of any runs. Many are asked for as one text; where a token begins tells whose it is."""
        out: list[bytes] = []
        for k in range(0, len(runs), ASKED):
            part = runs[k : k + ASKED]
            begins = np.cumsum([0, *(len(x) + 1 for x in part[:-1])])
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            raw = np.asarray(found.ids, "<u4").tobytes()
            at = np.searchsorted(np.fromiter(map(itemgetter(0), found.offsets), np.int64), begins)
            ends = [*(4 * at[1:]).tolist(), len(raw)]
            out += [raw[a:b] for a, b in zip((4 * at).tolist(), ends, strict=True)]
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's end.

        Texts are cut at blanks, which no token holds, and before marks that follow a word; each different run is looked up
        once, and ids are gathered by number.
        """
        flat = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")  # white space alike for the normalizer
        cut = pc.split_pattern(pc.replace_substring_regex(flat, MARKS, r"\1 \2"), " ")
        coded = cut.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        known = self.known.learn(names, self._ask)
        found = [known[name] for name in names]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, begins = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes[codes])
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(begins[codes] - (ends - sizes[codes]), sizes[codes])
        lists = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        return ids[places], np.concatenate([[0], ends])[lists[1:]]

    def __call__(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


_LIBRARY: dict[str, LibraryIds] = {}


def library_ids(path: str) -> LibraryIds:
    return _LIBRARY.get(path) or _LIBRARY.setdefault(path, LibraryIds(path))


def _opened(path: str):
    """The file system, by which a task reaches the shared folder, and the path in it."""
    return fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 2) -> DataFrame:
    """Encodes whole texts, each followed by `end_id`, and writes them into `folder`, in ascending doc_id order over
    and within files. Returns the files: shard (their order), file, n_docs, n_ids.

    A task writes a file under a name of its own; only files named here count, so a task that is lost and run again
    leaves at most an unused file. A null text is the empty text; a null doc_id comes first; rows with one doc_id
    are ordered by their text. Without rows there may be no file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        system, root = _opened(folder)
        system.create_dir(root, recursive=True)
        name, ids_of = f"ids-{shard:07d}-{uuid.uuid4().hex}", library_ids(path).encode_all
        end = np.uint32(end_id)
        with system.open_output_stream(f"{root}/{name}") as out:
            writer = TokenFileWriter(out)
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for rows in slices(text_sizes(batch.column("text")), TOGETHER):
                    found, ends = ids_of(batch.column("text")[rows])
                    for doc_id, at, to in zip(ids[rows], [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                        writer.add(doc_id, np.append(found[at:to], end))
            writer.close()
        if writer.docs:
            row = {"shard": [shard], "file": [f"{folder}/{name}"], "n_docs": [len(writer.docs)], "n_ids": [writer.ids]}
            yield pa.RecordBatch.from_pydict(row)
        else:
            system.delete_file(f"{root}/{name}")

    ordered = docs.select("doc_id", "text").withColumn("turn", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "turn").sortWithinPartitions("doc_id", "turn", "text")
    return checkpointed(ordered.mapInArrow(write, "shard long, file string, n_docs long, n_ids long"))


def read_token_files(files: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            system, name = _opened(row["file"])
            with system.open_input_file(name) as file:
                reader = TokenFileReader(file)
                starts = row["before"] + np.cumsum(reader.sizes) - reader.sizes
                sums: list[int] = []
                for i, parts in reader.documents():
                    crc = 0
                    for part in parts:
                        crc = zlib.crc32(part.astype("<u4", copy=False).data, crc)
                    sums.append(crc)
                    if len(sums) == ROWS or i + 1 == len(reader.sizes):
                        k = slice(i + 1 - len(sums), i + 1)
                        columns = {
                            "doc_id": pa.array(reader.doc_ids[k], pa.int64(), mask=~reader.named[k]),
                            "start": starts[k],
                            "n_tokens": reader.sizes[k],
                            "ids_crc32": pa.array(sums, pa.int64()),
                        }
                        yield pa.RecordBatch.from_pydict(columns)
                        sums = []

    # one row a file, so even the files of a very large input are few for one window
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = files.withColumn("before", before).repartition(max(1, files.count()))
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, folder: str | None = None, end_id: int = 2) -> DataFrame:
    """Writes the files of `docs` (below spark.checkpoint.dir where no folder is given) and reads them back."""
    folder = folder or scratch_dir(docs.sparkSession, "token-ids")
    return read_token_files(write_token_files(docs, path, folder, end_id))
