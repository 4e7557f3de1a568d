import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytrace.llm import toxicity as X
from tests.llm.helpers import LARGER, documents, odd_documents


def plain_marginals(emissions, moves):
    n = len(emissions)
    weights = {}
    for labels in itertools.product((0, 1), repeat=n):
        score = sum(e for e, label in zip(emissions, labels) if label)
        score += sum(moves[a, b] for a, b in zip(labels, labels[1:]))
        weights[labels] = np.exp(score)
    total = sum(weights.values())
    return [sum(w for labels, w in weights.items() if labels[t]) / total for t in range(n)]


@pytest.mark.parametrize("columns", [1, 2, 5, 1024])
def test_marginals_against_all_labellings(columns):
    draw = np.random.default_rng(columns)
    lengths = [1, 4, 9, 2, 7]
    moves = draw.normal(size=(2, 2))
    emissions = draw.normal(0, 2, sum(lengths))
    begins = np.zeros(len(emissions), bool)
    begins[np.cumsum([0, *lengths[:-1]])] = True
    expected, at = [], 0
    for n in lengths:
        expected += plain_marginals(emissions[at:at + n], moves)
        at += n
    assert X.marginals(emissions, begins, moves, columns) == pytest.approx(expected)


def test_pairs_against_all_labellings():
    draw = np.random.default_rng(3)
    moves, emissions = draw.normal(size=(2, 2)), draw.normal(size=6)
    begins = np.array([True, False, False, False, False, False])
    expected, total = np.zeros((2, 2)), 0.0
    for labels in itertools.product((0, 1), repeat=6):
        w = np.exp(sum(e for e, x in zip(emissions, labels) if x)
                   + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
        total += w
        for a, b in zip(labels, labels[1:]):
            expected[a, b] += w
    assert X._pairs(emissions, begins, moves, np.arange(1, 6)) == pytest.approx(expected / total)


def test_words_of_one_copied_document_are_no_evidence():
    words = np.array([7, 8] * 20 + [9, 3] * 20)
    contexts = np.array([1] * 40 + list(range(40)), np.uint64)
    doc = np.repeat(np.arange(40), 2)
    label = np.array([1] * 20 + [1] * 20 + [0] * 400)
    found = X.toxic_words(words, contexts, doc, label)
    assert found.tolist() == [3, 9]


def planted(n=600):
    draw = np.random.default_rng(5)
    rows, known = [], []
    for i in range(n):
        words = [f"w{draw.integers(500)}" for _ in range(draw.integers(3, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(int(draw.integers(len(words) + 1)),
                             ("scum", "é-trash!", "Moron")[draw.integers(3)])
        rows.append((i, " ".join(words)))
        known.append((i, 1, int(toxic)))
    return rows, known


def test_spans_and_scores(spark):
    rows, known = planted()
    docs = documents(spark, rows)
    labels = spark.createDataFrame(known, "doc_id bigint, quality int, toxic int")
    texts, toxic = dict(rows), {i: t for i, _, t in known}
    for r in X.evaluated(docs, labels).where("held_out").collect():
        assert r.predicted == toxic[r.doc_id]
        for s in r.spans:
            found = texts[r.doc_id][s.begin:s.end].lower()
            assert set(found.replace("-", " ").replace("!", " ").split()) <= {
                "scum", "é", "trash", "moron"}
        assert bool(r.spans) == bool(toxic[r.doc_id])


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = X.evaluated(docs, labels).where("held_out").join(labels, "doc_id").collect()
    y = np.array([r.toxic for r in rows])
    rank = np.empty(len(y))
    rank[np.argsort([r.score for r in rows])] = np.arange(len(y))
    ones = y.sum()
    assert (rank[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones)) > 0.9
    caught = sum(r.predicted for r in rows if r.toxic)
    wrong = sum(r.predicted for r in rows if not r.toxic)
    assert caught / ones > 0.8 and wrong / (len(y) - ones) < 0.03


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 1), (5, 1, 0), (None, 1, 1), (8, 1, None), (6, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    rows = X.evaluated(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    none = labels.where(F.lit(False))
    assert {r.score < 0.3 for r in X.evaluated(docs, none).collect()} == {True}
    assert X.evaluated(documents(spark, []), labels).count() == 0
