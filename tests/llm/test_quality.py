import math
import os
import struct

import numpy as np
import pytest
import xxhash as library
from pyspark.sql import functions as F

from skytrace.llm import linear
from skytrace.llm import quality as Q
from tests.llm.helpers import LARGER, documents, odd_documents


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    known = spark.read.parquet(f"{LARGER}/labels.parquet")
    unseen = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = Q.fit(docs, known.where(~unseen))
    rows = Q.scores(docs, model).join(known.where(unseen), "doc_id").collect()
    good = [r.keep for r in rows if r.quality == 1]
    bad = [r.keep for r in rows if r.quality == 0]
    assert sum(good) / len(good) >= 0.98
    assert sum(bad) / len(bad) <= 0.4
    assert all(0 <= s <= 1 for r in rows for s in (r.text_score, r.page_score, r.score))


def test_views_teach_each_other():
    """Two views, each informative, few labels: what each is taught by the other must help."""
    draw = np.random.default_rng(0)
    y = draw.integers(0, 2, 2040)
    views = [y[:, None] * 2.0 - 1 + draw.normal(0, 2.0, (len(y), 6)) for _ in range(2)]
    pupil = np.full(40, -1)

    def right(weights):
        return np.mean([((linear.apply_logistic(v[40:], w) > 0) == y[40:]).mean()
                        for v, w in zip(views, weights)])

    _, start = Q.fit_views([v[:40] for v in views], y[:40], pupil, False)
    at, label = np.arange(40), y[:40]
    for teacher in (0, 1):
        odds = linear.apply_logistic(views[teacher][40:], start[teacher])
        sure = np.argsort(-np.abs(odds))[:400] + 40
        at = np.concatenate((at, sure))
        label = np.concatenate((label, odds[sure - 40] > 0))
        pupil = np.concatenate((pupil, np.full(400, 1 - teacher)))
    _, end = Q.fit_views([v[at] for v in views], label, pupil, False)
    assert right(end) > right(start) + 0.01 and right(end) > 0.8


def plain_taught(rows, share, size, part):
    """Every decision of a round, row by row; ``rows`` are (doc_id, text_key, odds0, odds1)."""
    out = set()
    for teacher in (0, 1):
        odds = sorted(r[2 + teacher] for r in rows)
        n = len(odds)
        low = odds[max(0, math.ceil(part * (1 - share) * n) - 1)]
        high = odds[max(0, math.ceil((1 - part * share) * n) - 1)]
        for label, sure, wanted in (
                (1, [r for r in rows if r[2 + teacher] >= max(high, 1 + 1e-12)], share),
                (0, [r for r in rows if r[2 + teacher] <= min(low, -1 - 1e-12)], 1 - share)):
            order = sorted(sure, key=lambda r: (xxhash(r[1]), r[0]))
            out |= {(r[0], r[1], label, 1 - teacher) for r in order[:max(1, round(size * wanted))]}
    return out


def xxhash(value):
    found = library.xxh64_intdigest(struct.pack("<q", value), 42)
    return found - 2**64 if found >> 63 else found


@pytest.mark.parametrize("share, size, part", [(0.7, 10, 0.2), (0.4, 200, 0.05), (0.9, 3, 0.5)])
def test_teaching_against_plain_loops(spark, share, size, part):
    draw = np.random.default_rng(3)
    rows = [(i, int(draw.integers(-2**62, 2**62)), *draw.normal(0, 2, 2).tolist())
            for i in range(700)]
    free = spark.createDataFrame(rows, "doc_id bigint, text_key bigint, odds0 double, odds1 double")
    found = Q.taught(free, share, size, part).collect()
    assert {tuple(r) for r in found} == plain_taught(rows, share, size, part)
    assert len(found) == len({tuple(r) for r in found})


def test_all_other_rows_may_teach(spark):
    """Copies of one text fill most of the table; the texts that teach are distinct."""
    words = [f"good clean text number {i} with words" for i in range(60)]
    rows = [(i, words[i % 60] if i % 3 else "buy buy buy !!!") for i in range(900)]
    docs = documents(spark, rows)
    known = labels(spark, [(i, int(i % 3 != 0), 0) for i in range(60)])
    model = Q.fit(docs, known, rounds=2, taught_rows=5)
    scores = {r.doc_id: r.score for r in Q.scores(docs, model).collect()}
    assert all((s > 0.5) == bool(i % 3) for i, s in scores.items())


def test_logistic_model_by_its_gradient():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, 3))
    y = (draw.random(300) < linear.sigmoid(x @ [1, -2, 0.5] + 0.3)).astype(float)
    w = linear.fit_logistic(x, y, ridge=0.5)
    slope = np.hstack((x, np.ones((300, 1)))).T @ (linear.sigmoid(linear.apply_logistic(x, w)) - y)
    assert np.abs(slope + [*(0.5 * w[:3]), 0]).max() < 1e-3


def test_one_class_or_no_labels(spark):
    docs = documents(spark, [(1, "a"), (2, "b"), (3, None)])
    for rows, expected in (([], 1.0), ([(1, 1, 0)], 1.0), ([(1, 0, 0)], 0.0),
                           ([(1, None, 0), (9, 0, 0)], 1.0)):
        model = Q.fit(docs, labels(spark, rows))
        assert {r.score for r in Q.scores(docs, model).collect()} == {expected}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    known = labels(spark, [(1, 1, 0), (5, 0, 0), (5, 0, 1), (7, 1, None), (8, 0, 0), (2, 0, 0),
                           (None, 1, 1), (3, None, None)])
    model = Q.fit(docs, known)
    assert Q.scores(docs, model).count() == docs.count()
    kept = Q.keep_good(docs, known)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    assert Q.keep_good(documents(spark, []), known).count() == 0
    for name in ("__text", "__doc_id", "doc_ID_", "odds0", "text_key"):
        docs = docs.selectExpr("*", f"'x' as `{name}`")
    again = Q.keep_good(docs.withColumn("n_chars", F.lit("many")), known)
    assert again.columns == docs.columns
    again.collect()
