"""The pipeline's stages against plain decisions on their own input."""

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from skytrace.llm import decontaminate, langid, quality, simhash
from tests.llm.helpers import FOLDER
from tests.llm.test_simhash import plain_components, plain_fingerprint

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["quality_classifier", "language_id", "near_dedup",
                     "benchmark_decontamination", "best_fit_packing"]
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        before = {r.doc_id: r for r in docs.collect()}
        after = {r.doc_id for r in out.collect()}
        if name == "quality_classifier":
            found = quality.scores(docs, quality.fit(docs, labels)).collect()
            expected = {r.doc_id for r in found if r.score >= quality.MIN_SCORE}
        elif name == "language_id":
            expected = {r.doc_id for r in langid.predict(docs, langid.fit(docs)).collect()
                        if r.accepted}
        elif name == "near_dedup":
            ids = sorted(before)
            roots = plain_components([plain_fingerprint(before[i].text) for i in ids])
            expected = {ids[r] for r in roots}
        elif name == "benchmark_decontamination":
            leaked = {r.doc_id for r in decontaminate.leaks(docs, benchmark).collect()}
            expected = set(before) - leaked
        else:
            expected = set(before)
        assert after == expected, name
        if name != "best_fit_packing":
            assert out.columns == columns
            assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in before.values()}
            assert out.count() == len(after)
        docs = out


def test_run_is_registered(spark):
    rows = contract.queries()["pipeline"](spark, FOLDER)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                            "offset"]
    assert rows.count() > 0


def test_every_operator_has_one_query():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert simhash.DISTANCE == 4
