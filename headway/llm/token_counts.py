"""Token counts of whole texts by a byte-level BPE file, huge texts in overlapping chunks.

The library splits a text into words by a pattern that never looks back, and tokens never cross words. So if a position
is where a word begins in the whole text, everything from there on can be told from there on: an encoding that begins
earlier, even inside a word, is right from the first such position that it also has as the beginning of a word. A huge
text is encoded in chunks that overlap; the chunk to the left tells true beginnings up to a margin before its end (the
pattern looks at most two characters ahead, and the name of a special token may be cut off), and where both chunks have
one, they are spliced. Where the overlap has none, it is widened, in the end to the last splice, where
both agree; the right chunk grows along, so that even a text that is one word is encoded.

Ordinary texts are cut before blanks, where words always begin, and the library is asked once for each new piece.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.memory import Memory, slices

#: Characters of a chunk and of an overlap at first; bytes of texts handled at once.
CHUNK, OVERLAP, TOGETHER = 1 << 16, 256, 1 << 20
#: Bytes of remembered counts, a Python worker.
ROOM = 64 << 20
#: Pieces asked for as one text.
ASKED = 512
#: Characters that the word pattern looks at beyond a word's end.
LOOKAHEAD = 3

_LOOSE_BLANK = re.compile(r" (?=\s|\Z)")
_CUT = re.compile(r" (?=\S)")


class ByteBpe:
    """Encodes as the tokenizers library does, without adding special tokens; names of special tokens in a text are these."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, room: int = ROOM):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        names = [t["content"] for t in added]
        splitter = spec.get("pre_tokenizer") or {}
        plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
        strict = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        apart = not any(a[-k:] == b[:k] for a in names for b in names for k in range(1, min(len(a), len(b)) + (a != b)))
        if not (plain and strict and apart) or spec.get("normalizer") or spec["model"]["type"] != "BPE":
            raise ValueError("only byte-level BPE without a normalizer, with special tokens whose names can't overlap")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.margin = LOOKAHEAD + max(map(len, names), default=0)
        self.special = re.compile("|".join(map(re.escape, names)) or r"(?!)")
        self.chunk, self.overlap = chunk, max(overlap, 2 * self.margin)
        self.pieces, self.firsts = Memory(room * 3 // 4), Memory(room // 4)

    def _encoded(self, text: str, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a part, which of them begin words, and where in the whole text these words begin."""
        found = self.tokenizer.encode(text[begin:end], add_special_tokens=False)
        ids, words = np.asarray(found.ids, np.uint32), np.asarray(found.word_ids, np.int64)
        first = np.flatnonzero(np.diff(words, prepend=-1))
        offsets = found.offsets
        return ids, first, begin + np.fromiter((offsets[i][0] for i in first), np.int64, len(first))

    def spliced(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a whole text, chunk by chunk."""
        end, cut = min(len(text), self.chunk), 0
        ids, first, place = self._encoded(text, 0, end)
        while end < len(text):
            overlap = self.overlap
            while True:
                begin = max(end - overlap, cut)
                reach = min(len(text), end + max(self.chunk - overlap, end - begin))
                right = self._encoded(text, begin, reach)
                stable = place[(place >= max(cut, begin)) & (place <= end - self.margin)]
                common = np.intersect1d(stable, right[2], assume_unique=True)
                if len(common):
                    break
                overlap *= 2
            splice = common[-1]
            a, b = np.searchsorted(place, (cut, splice))
            yield ids[first[a] : first[b]]
            (ids, first, place), end, cut = right, reach, splice
        if len(ids):
            yield ids[first[np.searchsorted(place, cut)] :]

    def _counts(self, pieces: list[str]) -> list[int]:
        """Tokens of pieces that begin with a blank and something else than white space."""
        out: list[int] = []
        for k in range(0, len(pieces), ASKED):
            part = pieces[k : k + ASKED]
            begins = np.cumsum([0, *map(len, part)])
            found = self.tokenizer.encode("".join(part), add_special_tokens=False)
            starts = np.fromiter((o[0] for o in found.offsets), np.int64, len(found))
            out += np.diff(np.searchsorted(starts, begins[:-1]), append=len(starts)).tolist()
        return out

    def _whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[tuple[int, int]]:
        """Tokens and chunks of each text."""
        out: list[tuple[int, int]] = [(0, 0)] * len(texts)
        cut: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if len(text) > self.chunk:
                sizes = [len(ids) for ids in self.spliced(text)]
                out[i] = sum(sizes), len(sizes)
            elif self.special.search(text):
                out[i] = self._whole([text])[0], 1
            elif text:
                parts = _CUT.split(text) if _LOOSE_BLANK.search(text) else text.split(" ")
                cut[i] = [parts[0], *[" " + x for x in parts[1:]]]
        first = self.firsts.learn((parts[0] for parts in cut.values()), self._whole)
        later = self.pieces.learn((x for parts in cut.values() for x in parts[1:]), self._counts)
        for i, parts in cut.items():
            out[i] = first[parts[0]] + sum(map(later.__getitem__, parts[1:])), 1
        return out


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than `limit`) and n_chunks (encoded parts).

    A null text is the empty text: no bytes, tokens or chunks. Texts of any length are counted whole, longer ones than CHUNK
    characters in chunks, so a task holds the encoding of one chunk (of the longest word, if that is longer). Names of special tokens
    within a text are one token each, as in the library by default. Rows come back one for one, repeated ones and null ids
    too; an empty table gives an empty one; other columns are ignored.
    """
    fields = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType()), ("n_chunks", T.LongType())]
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), *(T.StructField(*f) for f in fields)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            column = pc.fill_null(batch.column(text), "")
            sizes = pc.binary_length(column).cast(pa.int64())
            for rows in slices(sizes.to_pylist(), TOGETHER):
                tokens, chunks = zip(*bpe.counts(column[rows].to_pylist()), strict=True)
                made = [pa.array(tokens, pa.int64()), pa.array([t > limit for t in tokens]), pa.array(chunks, pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(id)[rows], sizes[rows], *made], names=schema.names)

    return docs.select(F.col(id), F.col(text).cast("string").alias(text)).mapInArrow(count, schema)
