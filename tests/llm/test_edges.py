"""Every operator and stage on odd rows, clashing column names, repeated ids and empty tables."""

import os

import pytest

import corpus_pipeline as pipeline
from skytrace.llm import (
    alignment, decontaminate, exactdedup, langid, lm, packing, quality, simhash, syncmers,
    tokencount, toxicity,
)
from tests.llm.helpers import FOLDER, documents, odd_documents

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

#: Names that operators have used for columns of their own.
NAMES = ["__kept", "__text", "__plain", "__doc_id", "input0", "plain", "row", "id", "hash", "own",
         "text_hash", "component_id", "root", "text_key", "odds0", "pupil", "digest", "place",
         "block", "pair", "docs", "DOC_IDS", "same", "features"]


def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (5, 0, 1), (5, 0, None), (7, 1, 0), (8, 0, 1), (2, 0, 0), (None, 1, 1),
         (3, None, None)], "doc_id bigint, quality int, toxic int")


def benchmark(spark):
    return spark.createDataFrame(
        [(1, "one two three four five six"), (1, None), (None, "x y"), (2, "")],
        "item_id bigint, text string")


def odd(spark):
    frame = odd_documents(spark)
    for name in NAMES:
        if name.lower() not in map(str.lower, frame.columns):
            frame = frame.selectExpr("*", f"'other' as `{name}`")
    return frame


#: Operators with one result row for each row.
ROW_BY_ROW = {
    "quality": lambda s, d: quality.scores(d, quality.fit(d, labels(s), rounds=1)),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.fit(d, labels(s))),
    "lm": lambda s, d: lm.scores(d),
    "tokencount": lambda s, d: tokencount.counts(d),
    "langid": lambda s, d: langid.predict(d, langid.fit(d)),
    "syncmers": lambda s, d: syncmers.compared(d),
    "simhash": lambda s, d: simhash.groups(d),
    "exactdedup": lambda s, d: exactdedup.groups(d),
    "alignment": lambda s, d: alignment.counted(d),
}
OTHERS = {
    "packing": lambda s, d: packing.packed(d),
    "leaks": lambda s, d: decontaminate.leaks(d, benchmark(s)),
    "leaks_of_nothing": lambda s, d: decontaminate.leaks(d, benchmark(s).where("false"))
    if benchmark(s).where("false").count() else d.limit(0),
    "alignments": lambda s, d: alignment.alignments(d),
}
KEEPING = {
    "keep_good": lambda s, d: quality.keep_good(d, labels(s)),
    "keep_identified": lambda s, d: langid.keep_identified(d),
    "keep_one_near": lambda s, d: simhash.keep_one(d),
    "keep_one_exact": lambda s, d: exactdedup.keep_one(d),
    "clean": lambda s, d: decontaminate.clean(d, benchmark(s)),
}


@pytest.mark.parametrize("name", [*ROW_BY_ROW, *OTHERS])
def test_operator_on_odd_and_no_rows(spark, name):
    docs = odd(spark)
    run = ROW_BY_ROW.get(name) or OTHERS[name]
    rows = run(spark, docs).collect()
    if name in ROW_BY_ROW:
        assert len(rows) == docs.count()
        assert sorted(str(r.doc_id) for r in rows) == sorted(
            str(r.doc_id) for r in docs.select("doc_id").collect())
    assert run(spark, docs.where("false")).collect() == []


@pytest.mark.parametrize("name", KEEPING)
def test_kept_rows_are_input_rows(spark, name):
    docs = odd(spark)
    kept = KEEPING[name](spark, docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    before = [tuple(r) for r in docs.collect()]
    for row in kept.collect():
        before.remove(tuple(row))
    assert KEEPING[name](spark, docs.where("false")).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stage_on_odd_and_no_rows(spark, name):
    docs = odd(spark)
    stage = dict(pipeline.STAGES)[name]
    out = stage(spark, docs, FOLDER)
    rows = out.collect()
    if name != "best_fit_packing":
        assert out.columns == docs.columns
        before = [tuple(r) for r in docs.collect()]
        for row in rows:
            before.remove(tuple(row))
    assert stage(spark, docs.where("false"), FOLDER).collect() == []


def test_one_id_with_different_texts(spark):
    """Only rows of one group may go, whatever their ids."""
    one, other = "alpha beta gamma delta epsilon", "some entirely different words stand here"
    docs = documents(spark, [(4, one), (4, other), (9, one), (9, other), (4, one)])
    for keep in (simhash.keep_one, exactdedup.keep_one):
        assert sorted((r.doc_id, r.text) for r in keep(docs).collect()) == [(4, one), (4, other)]
