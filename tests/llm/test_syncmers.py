import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from skytrace.llm import syncmers as Y
from tests.llm.helpers import documents, invented, odd_documents


def signed(value):
    return value - 2**64 if value >> 63 else value


def chain(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return signed(seed)


def text_hash(text):
    return signed(xxhash.xxh64_intdigest(text.encode(), 42))


def pack(value, position):
    return (value & ~0xFFFFFF) | position


def plain_anchors(text):
    """Every five-word run whose smallest pair of words is its first or its last."""
    words = [text_hash(w) for w in re.split("[ \t-\r]+", text.strip(" \t\n\x0b\x0c\r"))]
    pairs = [chain(words[i:i + 2]) for i in range(len(words) - 1)]
    out = []
    for i in range(len(words) - 4):
        own = pairs[i:i + 4]
        if min(own) in (own[0], own[3]):
            out.append(pack(chain(words[i:i + 5]), i))
    return out or [pack(text_hash(text), 0)]


def plain_sketch(text):
    smallest = {}
    for a in sorted(plain_anchors(text)):
        smallest.setdefault(a >> 24, a)
    return [smallest[k] for k in sorted(smallest)]


def plain_likeness(a, b):
    places = [{x >> 24: x & 0xFFFFFF for x in s} for s in (a, b)]
    moved = [q - p for p, q in sorted((p, places[1][h]) for h, p in places[0].items()
                                      if h in places[1])]
    kept = sum(any(abs(moved[i] - moved[j]) <= 8 for j in (i - 1, i + 1) if 0 <= j < len(moved))
               for i in range(len(moved)))
    return max(kept, min(len(moved), 1)) / (len(a) + len(b) - len(moved))


def digits(anchors):
    return "".join(f"{a % 2**64:016x}" for a in anchors)


@pytest.mark.parametrize("range_bytes", [10**9, 300])
def test_against_plain_version(spark, range_bytes):
    texts = [t.replace(" ", "\n", 2) for t in invented(150)] + ["", "a", "é 😀 ß x y z w"]
    ids = [i * i - 7 for i in range(len(texts))]
    rows = Y.compared(documents(spark, list(zip(ids, texts))), range_bytes).collect()
    assert len(rows) == len(texts)
    by = {r.doc_id: r for r in rows}
    for k, (i, text) in enumerate(zip(ids, texts)):
        following = texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other, after = map(plain_sketch, (text, edited, following))
        r = by[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (digits(own), digits(other))
        assert r.near_edited == pytest.approx(plain_likeness(own, other))
        assert r.near_next == pytest.approx(plain_likeness(own, after))


def test_moved_passage_keeps_its_anchors(spark):
    words = [f"w{i * 7919 % 1000}" for i in range(120)]
    frame = spark.createDataFrame([(" ".join(words), "new words " * 30 + " ".join(words))],
                                  "a string, b string")
    near = frame.select(Y.passages(Y.sketch(F.col("a")), Y.sketch(F.col("b")))).first()[0]
    assert near > 0.4


def test_no_python_in_the_plan(spark, capsys):
    docs = spark.range(9).selectExpr("id as doc_id", "concat('a b ', id) as text")
    Y.compared(docs).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(name in plan for name in ("EvalPython", "InArrow", "InPandas", "BatchEval"))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    for size in (10, 10**9):
        rows = Y.compared(docs, size).collect()
        assert len(rows) == docs.count()
        prints = {r.doc_id: r.fingerprint for r in rows}
        assert prints[2] == prints[3] and prints[1] == prints[6]
    only = Y.compared(documents(spark, [(4, "a b c d e f g h")])).first()
    assert only.near_next == 1.0
    assert Y.compared(documents(spark, [])).count() == 0


def test_registered_query_keeps_all_anchors(spark, tmp_path):
    from skytrace.llm import registry

    texts = [t for t in invented(60)] + ["", "a b", " ".join(f"v{i * i % 977}" for i in range(3000))]
    documents(spark, list(enumerate(texts))).write.parquet(str(tmp_path / "documents.parquet"))
    by = {r.doc_id: r for r in registry.op8_syncmers(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        own, other, after = map(plain_sketch, (
            text, text[:len(text) - half] + following[:half], following))
        assert (by[i].fingerprint, by[i].edited_fingerprint) == (digits(own), digits(other))
        assert by[i].near_edited == pytest.approx(plain_likeness(own, other))
        assert by[i].near_next == pytest.approx(plain_likeness(own, after))


def test_passages_of_long_texts(spark):
    a, b, shared = ([f"{name}{i * 7919 % 100_003}" for i in range(n)]
                    for name, n in (("a", 20_000), ("b", 5_000), ("s", 60)))
    inserted = a[:10_000] + [f"new{i}" for i in range(12)] + a[10_000:]
    swapped = a[12_000:] + a[:12_000]
    rows = [(" ".join(x), " ".join(y)) for x, y in (
        (a[:15_000] + shared + a[15_000:], b[:100] + shared + b[100:]), (a, inserted), (a, swapped))]
    frame = spark.createDataFrame(rows, "a string, b string")
    whole = [Y.sketch(F.col(c)) for c in "ab"]
    near = [r[0] for r in frame.select(Y.passages(*whole)).collect()]
    assert near[0] * 13_000 > 20 and near[1] > 0.99 and near[2] > 0.99
