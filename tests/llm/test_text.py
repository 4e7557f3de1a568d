import re

import numpy as np
import pyarrow as pa

from skytrace.llm import text as T

TEXTS = ["a b  c", "", None, " x", "A\tB\n", "日本 b", "b", "x" * 3000 + " a", "\x1c a\x0b"]


def plain(text):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    return [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in found]


def test_words_are_told_apart_and_counted():
    hashes, firsts = T.word_hashes(*T.buffer_of(pa.array(TEXTS)))
    expected = [w for t in TEXTS for w in plain(t)]
    assert np.diff(firsts).tolist() == [len(plain(t)) for t in TEXTS]
    same = {}
    for word, value in zip(expected, hashes.tolist()):
        assert same.setdefault(word, value) == value
    assert len(set(same.values())) == len(same)


def test_hashes_do_not_depend_on_chunks(monkeypatch):
    whole = T.word_hashes(*T.buffer_of(pa.array(TEXTS)))[0]
    monkeypatch.setattr(T, "CHUNK_BYTES", 5)
    assert (T.word_hashes(*T.buffer_of(pa.array(TEXTS)))[0] == whole).all()


def test_sliced_arrays():
    array = pa.array(TEXTS)
    assert (T.word_hashes(*T.buffer_of(array[4:6]))[0]
            == T.word_hashes(*T.buffer_of(pa.array(TEXTS[4:6])))[0]).all()


def test_word_chunks_lose_nothing():
    for text in TEXTS:
        for size in (1, 2, 7, 5000):
            raw = (text or "").encode()
            assert [w for c in T.word_chunks(raw, size) for w in c] == plain(text)


def test_blocks_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": TEXTS})
    parts = list(T.blocks([batch], size=4))
    assert [v for p in parts for v in p.column(0).to_pylist()] == TEXTS
