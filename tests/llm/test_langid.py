import os
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from skytrace.llm import langid as L
from tests.llm.helpers import LARGER, documents, odd_documents


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    rows = L.evaluated(docs).join(docs.select("doc_id", "lang", F.length("text").alias("n")),
                                  "doc_id").where("held_out and lang is not null").collect()
    right = [r.lang == r.lang_pred for r in rows]
    # Some of the table's own labels are wrong.
    assert len(rows) > 100 and sum(right) / len(right) >= 0.96
    assert all(0 <= r.score <= 1 for r in rows)
    long = [r for r in rows if r.n > 200]
    assert sum(r.accepted for r in long) / len(long) >= 0.97


def test_smallest_dictionary_wins():
    words = {"x": b"alpha beta gamma delta ", "y": b"uno dos tres cuatro "}
    model = tuple((n, w * 20) for n, w in words.items())
    for name, content in words.items():
        found = L.decide(content * 3, model, 0.01)
        assert found[0] == name and found[3]
        assert int(L.sizes(content * 3, model).argmin()) == list(words).index(name)
    # Nothing speaks for either: the first one, without a margin.
    assert L.decide(b"qqq", model, 0.01)[::3] == ("x", False)


def test_blocks_cover_the_whole_text():
    model = (("x", b"alpha beta gamma " * 50), ("y", b"uno dos tres " * 50))
    mixed = b"alpha beta gamma " * 200 + b"uno dos tres " * 2000
    assert L.decide(mixed, model, 0.0)[0] == "y"


def test_short_texts_against_plain_loops():
    draw = random.Random(4)
    words = {name: ["".join(draw.choice(letters) for _ in range(draw.randint(2, 8)))
                    for _ in range(300)] for name, letters in (("x", "abcdef"), ("y", "efghij"))}
    model = tuple((name, " ".join(draw.choice(own) for _ in range(n)).encode())
                  for (name, own), n in zip(words.items(), (3000, 2000)))
    count = min(L.SLICES, min(len(c) for _, c in model) // L.SLICE)
    assert count > 1
    for text in (b"a", b"abc def", " ".join(words["y"][:20]).encode(), b"q" * (L.SHORT - 1)):
        expected = []
        for _, content in model:
            held = zstandard.ZstdCompressionDict(
                content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            with_all = zstandard.ZstdCompressor(
                level=L.LEVEL, dict_data=held, write_content_size=False, write_checksum=False,
                write_dict_id=False)
            alone = zstandard.ZstdCompressor(
                level=L.LEVEL, write_content_size=False, write_checksum=False)
            added = 0
            for i in range(count):
                begin = len(content) * i // count
                part = content[begin:begin + L.SLICE] + b" "
                added += len(alone.compress(part + text)) - len(alone.compress(part))
            expected.append((len(with_all.compress(text)) + added / count) / 2)
        assert L.measured(text, model).tolist() == pytest.approx(expected)
    long = b"ab " * L.SHORT
    assert L.measured(long, model).tolist() == L.sizes(long, model).tolist()


def test_too_many_languages_are_an_error(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(L.MAX_LANGUAGES + 1)]).withColumn(
        "lang", F.concat(F.lit("l"), F.col("doc_id").cast("string")))
    with pytest.raises(ValueError, match="more than 128 languages"):
        L.fit(docs)
    assert len(L.fit(docs.where("doc_id > 0"))) == L.MAX_LANGUAGES


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = L.evaluated(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id in (2, 3, 4):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns
    assert not {2, 3, 4} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "abc")]).withColumn("lang", F.lit(None).cast("string"))
    assert [r.lang_pred for r in L.evaluated(docs).collect()] == ["und"]
    assert L.evaluated(documents(spark, [])).count() == 0


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_short_documents_stay(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    plain = L.letters(F.col("text"))
    short = docs.withColumn("n", F.size(F.split(plain, " "))).where(
        (plain != "") & (F.col("n") < 6)).select("doc_id", "lang")
    # Openings of longer documents, so that there are enough of them.
    openings = docs.where(F.length(plain) > 300).select(
        (F.col("doc_id") + 10**9).alias("doc_id"), "lang",
        F.concat_ws(" ", F.slice(F.split(plain, " "), 20, 3)).alias("text"))
    rows = L.predict(openings, L.fit(docs)).join(openings, "doc_id").collect()
    assert len(rows) > 500
    assert sum(r.accepted for r in rows) / len(rows) >= 0.95
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.8
    kept = L.keep_identified(docs).join(short, "doc_id")
    assert kept.count() >= 0.9 * short.count() > 0
