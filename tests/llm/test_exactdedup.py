"""Exact duplicates against plain grouping of normalised texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as contract
from skytrace.llm import exactdedup
from tests.llm.helpers import FOLDER, documents, odd_documents


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain_groups(rows):
    """Sorted ``(doc_id, keep_id, group_size, kept, digest)`` of ``(doc_id, text)`` rows."""
    members = defaultdict(list)
    for doc_id, text in rows:
        members[normal(text)].append(doc_id)
    out = []
    for text, ids in members.items():
        order = sorted(ids, key=lambda i: (i is None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, order[0], len(ids), k == 0, digest) for k, i in enumerate(order)]
    return sorted(out, key=str)


def found(frame, **options):
    rows = exactdedup.groups(frame, **options).collect()
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex())
                   for r in rows], key=str)


def rows_with_copies(n):
    draw = random.Random(3)
    texts = [f"text {i}" for i in range(40)]
    # A third of all rows has one text, written with different white space.
    return [(draw.randrange(n), "hot \t\n text" if draw.random() < 0.2 else "hot text")
            if draw.random() < 0.35 else (draw.randrange(n), draw.choice(texts))
            for _ in range(n)]


@pytest.mark.parametrize("counters", [1, 3, 4096])
def test_groups_whatever_is_frequent(spark, counters):
    rows = rows_with_copies(600)
    frame = documents(spark, rows).repartition(7)
    assert found(frame, counters=counters) == plain_groups(rows)


def test_misra_gries_finds_all_frequent_digests(spark):
    rows = rows_with_copies(2000)
    digests = exactdedup.prints(documents(spark, rows).repartition(150)).cache()
    exact = Counter(normal(t) for _, t in rows)
    for counters in (1, 2, 30):
        assert len(exactdedup.candidates(digests, counters)) <= counters
        winners = exactdedup.frequent(digests, counters).collect()
        expected = [n for n in exact.values() if n * (counters + 1) > len(rows)]
        assert sorted(w.group_size for w in winners) == sorted(expected)


def test_reduced_counters_keep_the_bound():
    draw = np.random.default_rng(1)
    keys = draw.zipf(1.4, 5000) % 300
    kept = dict(zip(*exactdedup.reduced(keys, np.ones(len(keys), np.int64), 20)))
    assert len(kept) <= 20
    for key, count in Counter(keys.tolist()).items():
        assert count - len(keys) / 21 <= kept.get(key, 0) <= count


def test_odd_rows(spark):
    frame = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert found(frame) == plain_groups(rows)
    kept = exactdedup.keep_one(frame)
    assert kept.columns == frame.columns
    assert Counter(normal(r.text) for r in kept.collect()) == Counter({normal(t) for _, t in rows})


def test_empty_table(spark):
    frame = documents(spark, [(1, "a")]).where("false")
    assert exactdedup.groups(frame).count() == 0
    assert exactdedup.keep_one(frame).count() == 0


@pytest.mark.parametrize("counters", [2, 4096])
def test_keep_one_keeps_the_smallest_id_with_all_columns(spark, counters):
    rows = rows_with_copies(500) + [(None, "hot text"), (None, "only nulls"), (None, "only nulls")]
    frame = documents(spark, rows)
    for name in ("digest", "row", "own", "keep_id", "place"):
        frame = frame.selectExpr("*", f"'other' as {name}")
    kept = exactdedup.keep_one(frame, counters=counters)
    assert kept.columns == frame.columns
    expected = sorted(((d, i) for i, _, _, k, d in plain_groups(rows) if k), key=str)
    assert sorted(((hashlib.sha256(normal(r.text).encode()).hexdigest(), r.doc_id)
                   for r in kept.collect()), key=str) == expected


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = contract.queries()["op11_exact_dedup"](spark, FOLDER).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows],
                  key=str) == plain_groups([(d.doc_id, d.text) for d in docs])
