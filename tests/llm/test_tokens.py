import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_tables import clashing, documents  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm.memory import ENTRY
from headway.llm.bpe import WordBpe, encode_documents, word_bpe
from headway.llm.token_files import BLOCK, PAGE, LibraryIds, decode_page, encode_page, read_token_files, token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def library_ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def own_ids(text):
    return np.frombuffer(word_bpe(PATH).encode(text), "<u4").tolist()


PARTS = ["a", "the", "TION", "'s", "'RE", " ", "\n", "\t ", "Σ", "ΣΑΣ", "İ", "ß", "é", "é", "\x1c", "\x85", "\xa0", "1", "²", "!", "..", "<|endoftext|>"]
PARTS += ["<|startoftext|>", "<|", "漢字", "한", "😀", "_", "\x00", "​", "﻿", "ǅ", "ſ"]


def texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        some = [rng.choice(PARTS) if rng.random() < 0.8 else chr(rng.choice((rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x1FFFF)))) for _ in range(rng.randint(0, 25))]
        yield "".join(some)


def test_ids_are_the_librarys(library):
    asked = LibraryIds(PATH)
    for text in texts(1500, 1):
        want = library_ids(library, text)
        assert own_ids(text) == want, ascii(text)
        assert np.frombuffer(asked(text), "<u4").tolist() == want, ascii(text)


def test_words_of_few_letters_backtrack_as_merging_does(library):
    rng = random.Random(2)
    for _ in range(1500):
        word = "".join(rng.choice("ethanois") for _ in range(rng.randint(1, 40)))
        assert own_ids(word) == library_ids(library, word), word
    for word in ("a" * 301, "the" * 3000, "ab" * 5000):
        assert own_ids(word) == library_ids(library, word)


def test_decoding(library):
    bpe = word_bpe(PATH)
    for text in texts(300, 3):
        ids = library_ids(library, text)
        assert b"".join(bpe.decoded(np.array(ids, np.int64))).decode() == library.decode(ids, skip_special_tokens=False)


def test_memory_starts_over():
    small, asked = WordBpe(PATH, room=20 * ENTRY), LibraryIds(PATH, room=20 * ENTRY)
    for k in range(50):
        text = " ".join(f"word{i} x" for i in range(k, k + 4))
        assert small.encode(text) == word_bpe(PATH).encode(text) == asked(text)
        for memory in (small.runs, small.words, asked.known):
            assert len(memory.young) + len(memory.old) <= 40


def test_rows(documents, clashing, library):
    rows = [(1, None), (2, ""), (3, "The word, the word."), (3, "The word, the word."), (None, "x " * 40000), (4, "<|endoftext|>")]
    got = encode_documents(clashing(documents(rows)), PATH, outputs=("n_tokens", "token_ids", "decoded", "ids_sha256", "decoded_sha256"))
    found = {(r.doc_id, r.n_tokens): r for r in got.collect()}
    assert got.count() == len(rows)
    for doc_id, text in rows:
        ids = library_ids(library, text or "")
        r = found[doc_id, len(ids)]
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.token_ids, r.decoded) == (ids, decoded)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert encode_documents(documents([]), PATH).collect() == []
    with pytest.raises(ValueError, match="clash"):
        encode_documents(clashing(documents(rows)), PATH, keep=("doc_id", "n_tokens"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=700), st.sampled_from([1, 50, 49408, 2**32]))
def test_pages(ids, most):
    rows = np.array([x % most for x in ids], np.uint32)
    assert decode_page(encode_page(rows)).tolist() == rows.tolist()


def test_outliers_are_exceptions():
    rows = np.arange(BLOCK, dtype=np.uint32) % 8
    rows[[5, 77]] = 2**31
    assert len(encode_page(rows)) < len(encode_page(np.arange(BLOCK, dtype=np.uint32) % 1024))
    assert decode_page(encode_page(rows)).tolist() == rows.tolist()


def brute(rows, library):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library_ids(library, text or ""), 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files(documents, clashing, library, spark):
    rows = [(i * 37 % 101 - 20, f"text {i} " * (i % 9)) for i in range(101)] + [(500, None), (None, "no id"), (600, "very long " * PAGE)]
    got = token_files(clashing(documents(rows)).repartition(5), PATH)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == brute(rows, library)


def test_repeated_rows_and_no_rows(documents, library, tmp_path):
    rows = [(7, "same"), (7, "same"), (1, "b")]
    files = write_token_files(documents(rows), PATH, str(tmp_path))
    assert files.agg({"n_docs": "sum"}).first()[0] == 3
    assert sorted(map(tuple, read_token_files(files).collect()), key=lambda r: r[1]) == brute(rows, library)
    assert token_files(documents([]), PATH).collect() == []
