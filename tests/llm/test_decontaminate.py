import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skytrace.llm import decontaminate as D
from skytrace.llm import text as T
from tests.llm.helpers import documents, odd_documents


def words_of(seed, n, size=300):
    draw = random.Random(seed)
    return [f"v{int(size * draw.random() ** 2)}" for _ in range(n)]


ITEMS = [(i, " ".join(words_of(i, 20 + 5 * i)) + ("? answer of it here now so" if i % 2 else "."))
         for i in range(12)] + [(50, "short one"), (51, ""), (52, None), (53, "The End?")]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id bigint, text string")


def plain_scores(passage, units, frequencies, n, mean):
    out = []
    for unit in units:
        def weight(w, uses):
            idf = math.log1p((n - frequencies[w] + 0.5) / (frequencies[w] + 0.5))
            return idf * uses * 2.2 / (uses + 1.2 * (0.25 + 0.75 * len(unit) / mean))

        uses = Counter(unit)
        full = sum(weight(w, k) for w, k in uses.items())
        out.append(sum(weight(w, uses[w]) for w in set(passage) if w in uses) / full)
    return out


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.7])
def test_retrieval_finds_all_above_threshold(spark, threshold):
    index = next(D.indexes(benchmark(spark)))
    texts = [t.encode().lower().split() for _, t in sorted(
        ((i, t) for i, t in ITEMS if t), key=lambda x: x[0])]
    units = [t[i:i + 64] for t in texts for i in range(0, len(t), 64)]
    frequencies = Counter(w for t in texts for w in set(t))
    mean = sum(map(len, texts)) / len(ITEMS)
    docs = [" ".join(words_of(100 + i, 90)) for i in range(20)]
    docs += [" ".join(words_of(200, 40) + t.decode().split() + words_of(201, 33))
             for t in (b" ".join(x) for x in texts)]
    hashes, firsts = T.word_hashes(*T.buffer_of(pa.array(docs)))
    index.largest = index.largest  # the search reads it
    old, D.THRESHOLD = D.THRESHOLD, threshold
    try:
        passages, terms, owner = D.passages_of(hashes, firsts, index)
    finally:
        D.THRESHOLD = old
    found = {(p, u): s for p, u, s in zip(*(x.tolist() for x in index.search(
        passages, terms, threshold)))}
    expected, number = {}, 0
    for d in docs:
        own = d.encode().split()
        for begin in range(0, len(own), 32):
            for u, s in enumerate(plain_scores(own[begin:begin + 64], units, frequencies,
                                               len(ITEMS), mean)):
                if s >= threshold:
                    expected[number, u] = s
            number += 1
    assert number == len(owner)
    assert found.keys() == expected.keys()
    for key, s in expected.items():
        assert found[key] == pytest.approx(s)


def test_planted_items_are_found(spark):
    draw = random.Random(4)
    rows, expected = [], set()
    for k in range(60):
        words = words_of(1000 + k, draw.randint(0, 400), 5000)
        if k % 3 == 0:
            item = ITEMS[draw.randrange(12)]
            at = draw.randint(0, len(words))
            words[at:at] = item[1].upper().split()
            expected.add((k, item[0]))
        rows.append((k, "  ".join(words)))
    docs = documents(spark, rows)
    found = {(r.doc_id, r.item_id) for r in D.leaks(docs, benchmark(spark)).collect()}
    assert found == expected
    kept = {r.doc_id for r in D.clean(docs, benchmark(spark)).collect()}
    assert kept == {k for k, _ in rows} - {k for k, _ in expected}


def test_parts_of_the_index_give_the_same(spark):
    rows = [(i, "before " * 5 + t + " after") for i, t in ITEMS if t]
    docs = documents(spark, rows)
    whole = {tuple(r) for r in D.leaks(docs, benchmark(spark)).collect()}
    assert len(list(D.indexes(benchmark(spark), 200))) > 3
    parts = set()
    for index in D.indexes(benchmark(spark), 200):
        batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows],
                                            "text": [t for _, t in rows]})
        for b in D._leaks([batch], [index], threshold=D.THRESHOLD, question=D.QUESTION_OVERLAP,
                          answer=D.ANSWER_OVERLAP):
            parts |= {tuple(r.values()) for r in b.to_pylist()}
    assert {x[:2] for x in parts} == {x[:2] for x in whole}
    assert {(i, i) for i, _ in rows} <= {x[:2] for x in whole}


def test_question_and_answer():
    assert D.question_words(b"who is it? me .".split()) == 3
    assert D.question_words(b"first. then last".split()) == 1
    assert D.question_words(b"a b c d".split()) == 3
    assert len(D.shingle_hashes(np.arange(3, dtype=np.uint64))) == 1
    assert len(D.shingle_hashes(np.zeros(0, np.uint64))) == 0


def test_odd_rows(spark):
    docs = odd_documents(spark)
    items = benchmark(spark, [(1, "one two three four five six"), (1, "x y"), (None, "x y")])
    found = D.leaks(docs, items).collect()
    assert {r.doc_id for r in found} == {1, 6, None}
    assert sum(r.doc_id == 6 for r in found) == 2
    assert {r.doc_id for r in D.clean(docs, items).collect()} == {2, 3, 4, 5, 7, 8, -9, None}
    assert D.clean(docs, items).columns == docs.columns
    assert D.leaks(docs, benchmark(spark, [])).count() == 0
    assert D.leaks(documents(spark, []), items).count() == 0


def test_search_holds_a_bounded_part_of_a_batch(spark):
    """Eight megabytes of passages that share their terms with the items."""
    index = next(D.indexes(benchmark(spark)))
    texts = [" ".join(words_of(300 + i, 2000)) for i in range(40)]
    texts += [texts[i % 40] + " " + ITEMS[5 + i % 6][1] for i in range(40)]
    texts *= -(-(8 << 20) // sum(map(len, texts)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)],
                                       ["doc_id", "text"])
    limits = D._limits(D.THRESHOLD, D.QUESTION_OVERLAP, D.ANSWER_OVERLAP)
    tracemalloc.start()
    try:
        kept = sum(b.num_rows for b in D._clean([batch], [index], **limits))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert kept == len(texts) // 2
    assert peak < 64 << 20
