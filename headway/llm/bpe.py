"""Exact byte-pair encoding in linear time by backtracking over longest matches, and decoding from an offset table.

Merging pairs in rank order gives the only sequence of tokens in which each token is what its own characters merge to
and no merge would have crossed a boundary between neighbours. So instead of merging, the encoder takes the longest
token that an Aho-Corasick automaton finds at a place, keeps it if its pair with the token before is compatible, tries
the next shorter prefix otherwise, and steps back where nothing fits; places once found dead aren't tried again.

The tokenizer file's normalizer (NFC, white space, lower case) and word pattern work within runs of non-space
characters, so such runs are the unit that is remembered.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from string import ascii_letters

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from headway.llm.memory import Memory, slices

#: Bytes of runs and words remembered by a Python worker, over both.
ROOM = 64 << 20
#: Pairs of symbols whose compatibility is remembered, in a table of so many places: a power of two.
PAIR_PLACES = 1 << 18
#: Bytes of texts handled at once, or one longer text.
TOGETHER = 1 << 20
#: Ids decoded at once.
DECODED_AT_ONCE = 1 << 18

WORD_END = "</w>"
#: Marks that are one word of their own after letters.
MARKS = ".,;:!?"
#: White space for str.split(), but not for the tokenizer.
NOT_SPACES = "\x1c\x1d\x1e\x1f"
_LATE = 1 << 60


def runs(text: str) -> list[str]:
    """The pieces between white space. Where Python splits at characters that the tokenizer doesn't take for white
    space, the text is one piece."""
    return [text] if any(c in text for c in NOT_SPACES) else text.split()


class Merges:
    """The merge rules of a vocabulary: which neighbours can stand beside each other, and the tokens of a word.

    Symbols are numbered by first use: single characters, then merges in rank order, so a symbol's number tells when
    it is made. A character that ends a word is another character than the same one within it.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        made = {a + b for a, b in pairs}
        names = [*(t for t in vocabulary if t not in made), *(a + b for a, b in pairs)]
        place = {name: i for i, name in enumerate(names)}
        if len(place) != len(names):
            raise ValueError("a token is made by more than one merge")
        self.single = len(names) - len(pairs)
        self.ids = [vocabulary[name] for name in names]
        self.parts = [(-1, -1)] * self.single + [(place[a], place[b]) for a, b in pairs]
        if any(max(p) >= i for i, p in enumerate(self.parts) if i >= self.single):
            raise ValueError("a merge uses a token that is made later")
        self.merge = {p: i for i, p in enumerate(self.parts) if i >= self.single}
        self.left, self.right = self._spines(0), self._spines(1)
        self.pairs = array("q", [-1]) * PAIR_PLACES  # the pair last asked for at each place, and the answer
        whole = [True] * self.single
        for i in range(self.single, len(names)):
            a, b = self.parts[i]
            whole.append(whole[a] and whole[b] and self._meet(a, b, i))
        self.automaton = ahocorasick.Automaton()
        spelled = [self._spelling(name) for name in names]
        for i, s in enumerate(spelled):
            if whole[i]:
                self.automaton.add_word(s, i)
        self.length = [len(s) for s in spelled]
        self.shorter = [-1] * len(names)
        for i, s in enumerate(spelled):
            if whole[i] and len(s) > 1 and (n := self.automaton.longest_prefix(s[:-1])):
                while not self.automaton.exists(s[:n]):
                    n -= 1
                self.shorter[i] = self.automaton.get(s[:n])
        self.automaton.make_automaton()

    @staticmethod
    def _spelling(name: str) -> str:
        if name.endswith(WORD_END) and len(name) > len(WORD_END):
            name = name[: -len(WORD_END)]
            return name[:-1] + chr(ord(name[-1]) + 0x1000)
        return name

    def _spines(self, side: int) -> list[tuple[int, ...]]:
        """For each symbol, what stands at its left (0) or right (1) edge while it is made, in order."""
        spines: list[tuple[int, ...]] = []
        for i, p in enumerate(self.parts):
            spines.append((i,) if i < self.single else (*spines[p[side]], i))
        return spines

    def _meet(self, a: int, b: int, limit: int = _LATE) -> bool:
        """Whether a and b, made side by side, stay apart until `limit`. Where two merges have the same rank, the one
        further left goes first."""
        one, two = self.right[a], self.left[b]
        i = j = 0
        while True:
            crossing = self.merge.get((one[i], two[j]), _LATE)
            after_left = one[i + 1] if i + 1 < len(one) else _LATE
            after_right = two[j + 1] if j + 1 < len(two) else _LATE
            if crossing < limit and crossing < after_left and crossing <= after_right:
                return False
            if after_left == after_right == _LATE:
                return True
            if after_left <= after_right:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        pair = a << 32 | b << 1
        place = (a * 0x9E3779B1 ^ b * 0x85EBCA6B) >> 5 & PAIR_PLACES - 1
        known = self.pairs[place]
        if known >> 1 != pair >> 1:
            known = self.pairs[place] = pair | self._meet(a, b)
        return bool(known & 1)

    def encode(self, word: str) -> list[int]:
        """The ids of one word, spelled in the byte alphabet."""
        if not word:
            return []
        spelled = word[:-1] + chr(ord(word[-1]) + 0x1000)
        n, length = len(spelled), self.length
        longest = [-1] * n
        for end, symbol in self.automaton.iter(spelled):
            longest[end + 1 - length[symbol]] = symbol  # ends only grow
        dead, out, at, symbol = bytearray(n + 1), [], 0, longest[0]
        while at < n:
            while symbol >= 0:
                end = at + length[symbol]
                if not dead[end] and (not out or self.compatible(out[-1], symbol)):
                    break
                symbol = self.shorter[symbol]
            if symbol >= 0:
                out.append(symbol)
                at = end
                symbol = longest[at] if at < n else -1
            else:
                if not out:
                    raise ValueError(f"no tokens for {word[:100]!r}")
                dead[at] = 1
                last = out.pop()
                at -= length[last]
                symbol = self.shorter[last]
        return [self.ids[x] for x in out]


class WordBpe:
    """Encodes and decodes as the tokenizer file asks for. Its normalizer and word splitter are the library's; merging
    and decoding are done here."""

    def __init__(self, path: str, room: int = ROOM):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        file = Tokenizer.from_file(path)
        self.normalize, self.split = file.normalizer.normalize_str, file.pre_tokenizer.pre_tokenize_str
        self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.between = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        self.words, self.runs = Memory(room // 2), Memory(room // 2)
        self.lowers = self._plain(ascii_letters + MARKS) == [ascii_letters.lower(), MARKS]
        names = {i: t for t, i in [*spec["model"]["vocab"].items(), *self.special.items()]}
        pieces = [names[i].encode() + b" " for i in range(len(names))]
        self.offsets = np.cumsum([0, *map(len, pieces)])
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def _plain(self, run: str) -> list[str]:
        return [word for word, _ in self.split(self.normalize(run))] if run else []

    def _parts(self, run: str) -> list[str | bytes]:
        """The words of a run, and the ids of the special tokens that it names; these stand before anything is normalized."""
        word = run.rstrip(MARKS)
        if self.lowers and word.isascii() and word.isalpha():  # as the normalizer and the splitter would
            return [word.lower()] if word == run else [word.lower(), run[len(word) :]]
        out, at = [], 0
        for found in self.between.finditer(run):
            out += [*self._plain(run[at : found.start()]), np.uint32(self.special[found[0]]).astype("<u4").tobytes()]
            at = found.end()
        return [*out, *self._plain(run[at:])]

    def _words(self, words: list[str]) -> list[bytes]:
        return [np.asarray(self.merges.encode(word), "<u4").tobytes() for word in words]

    def _runs(self, runs: list[str]) -> Iterator[bytes]:
        parted = [self._parts(run) for run in runs]
        words = self.words.learn((x for parts in parted for x in parts if isinstance(x, str)), self._words)
        return (b"".join([words[x] if isinstance(x, str) else x for x in parts]) for parts in parted)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; what is new in all of them is worked out together."""
        cut = [runs(text) for text in texts]
        known = self.runs.learn(chain.from_iterable(cut), self._runs)
        return [b"".join(map(known.__getitem__, parts)) for parts in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decoded(self, ids: np.ndarray) -> Iterator[bytes]:
        """The decoded UTF-8 text of ids, in parts: token names between spaces."""
        for k in range(0, len(ids), DECODED_AT_ONCE):
            part = ids[k : k + DECODED_AT_ONCE]
            begin = self.offsets[part]
            sizes = self.offsets[part + 1] - begin
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(begin - (ends - sizes), sizes)
            last = len(ids) <= k + DECODED_AT_ONCE
            yield self.bytes[at[: len(at) - last]].tobytes()  # no space after the last token


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


OUTPUTS = {
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
    "token_ids": T.ArrayType(T.IntegerType()),
    "decoded": T.StringType(),
}


def text_sizes(texts: pa.Array) -> list[int]:
    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()


def _coded(batch: pa.RecordBatch, path: str, text: str, outputs: tuple[str, ...]) -> pa.RecordBatch:
    bpe = word_bpe(path)
    made: dict[str, list] = {name: [] for name in outputs}
    for raw in bpe.encode_all([value or "" for value in batch.column(text).to_pylist()]):
        ids = np.frombuffer(raw, "<u4").astype(np.int64)
        if "n_tokens" in made:
            made["n_tokens"].append(len(ids))
        if "ids_sha256" in made:
            made["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
        if "token_ids" in made:
            made["token_ids"].append(ids.astype(np.int32))
        if "decoded" in made:
            made["decoded"].append(b"".join(bpe.decoded(ids)).decode())
        if "decoded_sha256" in made:
            digest = hashlib.sha256()
            for part in bpe.decoded(ids):
                digest.update(part)
            made["decoded_sha256"].append(digest.hexdigest())
    kinds = {"n_tokens": pa.int64(), "token_ids": pa.list_(pa.int32())}
    kept = [name for name in batch.schema.names if name != text]
    arrays = [batch.column(name) for name in kept] + [pa.array(v, kinds.get(n, pa.string())) for n, v in made.items()]
    return pa.RecordBatch.from_arrays(arrays, names=[*kept, *made])


def encode_documents(
    docs: DataFrame,
    path: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    outputs: tuple[str, ...] = ("n_tokens", "token_ids"),
) -> DataFrame:
    """Every row's `keep` columns and the wanted OUTPUTS of its whole text: ids, their count and digest, and what the
    ids decode to, as text or digest.

    A null text is the empty text: no ids, decoded to the empty text. Rows come back one for one, repeated ones too;
    an empty table gives an empty one. Kept columns may have any type, but no name of an output (ValueError).
    """
    if clash := set(keep) & (set(outputs) | {text}):
        raise ValueError(f"columns clash with outputs: {sorted(clash)}")
    fields = [T.StructField(n, docs.schema[n].dataType) for n in keep] + [T.StructField(n, OUTPUTS[n]) for n in outputs]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(text_sizes(batch.column(text)), TOGETHER):
                yield _coded(batch.slice(rows.start, rows.stop - rows.start), path, text, outputs)

    return docs.select(*keep, text).mapInArrow(code, T.StructType(fields))
