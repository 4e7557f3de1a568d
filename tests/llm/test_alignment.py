"""Alignment against plain encoding of whole texts and comparison of all ends."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from skytrace.llm import alignment
from tests.llm.helpers import FOLDER, documents, odd_documents

ODD = ["", " ", "  ", "a ", " a", "a  b", "▁", "a ▁ b", "x <|endoftext|> y", "<s> a </s>",
       "日本語 émoji 😀 ß", "a\tb\n\nc", "a\x00b", "tail   ", "\n", "　x", "ＡＢＣ ﬁ", "a",
       "it's we'll  DON'T", "ééé ééé éé", "😀" * 9, "word " * 300, "x" * 3000]


@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(*alignment.load())


def plain(text, encoders):
    """Groups, links and ids of one text, by comparing everything with everything."""
    if not text:
        return [], [], [], []
    ids = [encoders.first.encode(" " + text, add_special_tokens=False).ids,
           encoders.second.encode(text)]
    if any(b"".join(encoders.bytes[s][i] for i in ids[s]) != (" " + text).encode() for s in (0, 1)):
        return [], [], [], []
    ends = [np.cumsum([len(encoders.bytes[s][i]) for i in ids[s]]).tolist() for s in (0, 1)]
    both = sorted(set(ends[0]) & set(ends[1]))
    groups = [tuple([i for i, e in zip(ids[s], ends[s]) if low < e <= high] for s in (0, 1))
              for low, high in zip([0, *both], both)]
    spans = [list(zip([0, *e], e)) for e in ends]
    links = [(a, b) for a, (p, q) in zip(ids[0], spans[0]) for b, (r, s) in zip(ids[1], spans[1])
             if max(p, r) < min(q, s)]
    return groups, links, *ids


def written_out(groups):
    text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    return hashlib.sha256(text.encode()).hexdigest() if groups else ""


def expected(rows, encoders):
    """All columns of the query for ``(doc_id, text)`` rows."""
    known = {t: plain(t, encoders) for t in {t for _, t in rows}}
    held = Counter()
    for _, text in rows:
        held.update(set(known[text][1]))
    highest = defaultdict(int)
    for (a, _), n in held.items():
        highest[a] = max(highest[a], n)
    return sorted([(i, len(a), len(b), len(groups), len(links),
                    sum(held[p] == highest[p[0]] for p in links), sum(held[p] for p in links),
                    written_out(groups))
                   for i, t in rows for groups, links, a, b in [known[t]]], key=str)


def found(frame):
    return sorted([tuple(r) for r in frame.collect()], key=str)


def test_query_on_whole_table(spark, encoders):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = [(d.doc_id, d.text) for d in docs if len(d.text or "") < 8000]
    frame = documents(spark, rows).repartition(5)
    assert found(alignment.counted(frame, block_bytes=30_000)) == expected(rows, encoders)
    whole = contract.queries()["op12_alignment"](spark, FOLDER)
    assert whole.count() == len(docs)
    assert whole.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                             "groups_sha256"]


def test_odd_texts(spark, encoders):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD + ["a b"] * 7)] + [(99, None)]
    frame = documents(spark, rows)
    for name in ("block", "pair", "number", "links", "at", "first", "docs"):
        frame = frame.selectExpr("*", f"'other' as {name}")
    assert found(alignment.counted(frame)) == expected(rows, encoders)


def test_odd_rows_and_empty_tables(spark, encoders):
    frame = odd_documents(spark)
    assert alignment.counted(frame).count() == frame.count()
    assert alignment.counted(frame.where("false")).count() == 0
    assert alignment.alignments(frame.where("false")).count() == 0


def test_groups_come_back(spark, encoders):
    rows = list(enumerate(ODD))
    for row in alignment.alignments(documents(spark, rows)).collect():
        groups, _, a, b = plain(ODD[row.doc_id], encoders)
        assert (row.a_ids, row.b_ids) == (a, b)
        cuts = [[c + 1 for c in own] for own in (row.a_cuts, row.b_cuts)]
        assert [(row.a_ids[p:q], row.b_ids[r:s]) for p, q, r, s in zip(
            [0, *cuts[0]], cuts[0], [0, *cuts[1]], cuts[1])] == groups


def test_stretches_give_the_ids_of_whole_texts(encoders):
    draw = random.Random(5)
    signs = "ab c  .,'\n\té日<|>s/1▁\U0001F600 "
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 60))) for _ in range(800)]
    result = alignment.aligned(pa.array(texts), encoders)
    for k, text in enumerate(texts):
        for side in (0, 1):
            begin, end = result.begins[side][k:k + 2]
            assert result.ids[side][begin:end].tolist() == plain(text, encoders)[2 + side]


def test_forgetting_changes_nothing(encoders, monkeypatch):
    texts = pa.array([f"word{i} and word{i % 7} more" for i in range(200)])
    before = alignment.aligned(texts, encoders)
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    for _ in range(2):
        again = alignment.aligned(texts, encoders)
        assert all((a == b).all() for a, b in zip(before.ids, again.ids))


@given(st.lists(st.tuples(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400))), max_size=6))
@settings(max_examples=200, deadline=None)
def test_galloping_is_a_search_in_sorted_lists(lists):
    shorter, longer = [], []
    for a, b in lists:
        short, long = sorted((sorted(a | {500}), sorted(b | {500})), key=len)
        shorter.append(short)
        longer.append(long)
    begins = [alignment._offsets([len(x) for x in own]) for own in (shorter, longer)]
    flat = [np.array([v + 1000 * i for i, x in enumerate(own) for v in x], np.int64)
            for own in (shorter, longer)]
    at = alignment.positions(flat[0], begins[0], flat[1], begins[1])
    assert at.tolist() == np.searchsorted(flat[1], flat[0]).tolist()


@given(st.lists(st.integers(0, 2**33)))
def test_packed_numbers_come_back(values):
    data, begins = alignment.packed(np.array(values, np.int64))
    numbers, ends = alignment.unpacked(data)
    assert numbers.tolist() == values
    assert (ends + 1).tolist() == begins[1:].tolist()
