"""Whitening against numpy's eigenvectors and exact whole numbers."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from skytrace.llm import whitening
from tests.llm.helpers import FOLDER

FIELDS = "vec_id bigint, embedding array<float>, label int"


def symmetric(values, seed=0):
    draw = np.random.default_rng(seed)
    q, _ = np.linalg.qr(draw.standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    [3.0], [2.0, 1.0], list(range(1, 33)), [5.0] * 6 + [1.0] * 4, [1e9, 1.0, 1e-9, 1e-12],
    [7.0] + [7.0 + 1e-12] * 3 + [0.0] * 5, [1.0 + 1e-7 * i for i in range(40)], [0.0, 0.0, 4.0],
])
def test_leading_pairs(values):
    matrix = symmetric(values)
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading_pairs(matrix, 8)
    expected = np.sort(values)[::-1][:8]
    scale = max(values)
    assert np.abs(found - expected).max() <= 1e-13 * scale * len(values)
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-13
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() <= 1e-13 * scale * len(values)


@given(st.integers(2, 24), st.integers(0, 10**6), st.floats(-8, 8))
@settings(max_examples=60, deadline=None)
def test_sturm_counts_and_reflections(size, seed, power):
    draw = np.random.default_rng(seed)
    matrix = draw.standard_normal((size, size)) * 10 ** power
    matrix = matrix + matrix.T
    diagonal, beside, _ = whitening.tridiagonal(matrix)
    exact = np.linalg.eigvalsh(matrix)
    again = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1))
    assert np.abs(exact - again).max() <= 1e-12 * np.abs(exact).max() * size
    points = draw.uniform(exact[0] * 1.1, exact[-1] * 1.1, 9)
    counts = whitening.sturm_count(diagonal, beside, points)
    near = np.abs(points[:, None] - exact).min(axis=1) < 1e-9 * np.abs(exact).max()
    assert ((counts == (exact < points[:, None]).sum(axis=1)) | near).all()


def test_matrices_without_a_scale():
    for power in (-280, 0, 280):
        values, vectors = whitening.leading_pairs(np.diag([3.0, 2.0, 1.0]) * 10.0 ** power, 2)
        assert np.allclose(values / 10.0 ** power, [3, 2])
        assert np.allclose(np.abs(vectors), [[1, 0, 0], [0, 1, 0]])
    assert len(whitening.leading_pairs(np.zeros((4, 4)), 2)[0]) == 0


def plain(vectors, wanted=8):
    """What the query is to return, by numpy, for clean vectors."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors])
    n, sums = len(x), x.sum(axis=0)
    deviations = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = x - sums / n
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    values, columns = values[::-1][:wanted], columns[:, ::-1][:, :wanted]
    return deviations, centred @ columns / np.sqrt(values), values / x.var(axis=0).sum()


def compare(rows, ids, vectors, wanted=8):
    deviations, whitened, explained = plain(vectors, wanted)
    assert len(rows) == whitened.size
    place = {i: k for k, i in enumerate(ids)}
    found = np.zeros_like(whitened)
    for r in rows:
        found[place[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviations[place[r.vec_id]] and r.n == len(ids)
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
    signs = np.sign((found * whitened).sum(axis=0))
    assert np.abs(found - whitened * signs).max() < 1e-6


def test_query(spark):
    rows = contract.queries()["op13_whitening"](spark, FOLDER).collect()
    given_rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    clean = [r for r in given_rows if r.embedding is not None and all(
        c is not None and math.isfinite(c) for c in r.embedding)]
    compare(rows, [r.vec_id for r in clean], [r.embedding for r in clean])
    error = {r.identity_error for r in rows}
    assert len(error) == 1


def test_unusable_vectors_and_many_partitions(spark):
    draw = np.random.default_rng(5)
    good = [(i, [float(np.float32(c)) for c in draw.standard_normal(3) * [1, 5, 0.2] + 9], 0)
            for i in range(300)]
    bad = [(1000, None, 0), (1001, [], 0), (1002, [1.0, None, 2.0], 0),
           (1003, [1.0, math.nan, 2.0], 0), (1004, [math.inf, 1.0, 2.0], 0),
           (1005, [1.0, 2.0], 0), (1006, [1e30, 0.0, 0.0], 0), (1007, [1.0, 2.0, 3.0, 4.0], 0)]
    frame = spark.createDataFrame(good + bad, FIELDS).repartition(90)
    for name in ("entries", "size", "at", "whitened", "n"):
        frame = frame.selectExpr("*", f"'other' as {name}")
    compare(whitening.components(frame).collect(), [g[0] for g in good], [g[1] for g in good], 3)


def test_tables_without_components(spark):
    same = [(i, [1.0, 2.0], 0) for i in range(5)]
    for rows in ([], same, same[:1], [(1, None, 0)], [(1, [], 0)]):
        assert whitening.components(spark.createDataFrame(rows, FIELDS)).collect() == []


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0], 0), (7, [0.0, 1.0], 0), (7, [0.0, 1.0], 0), (8, [3.0, -2.0], 0)]
    found = whitening.components(spark.createDataFrame(rows, FIELDS)).collect()
    assert sorted(str(r.vec_id) for r in found if r.component == 1) == ["7", "7", "8", "None"]
    assert all(r.n == 4 for r in found)


def test_large_numbers_stay_exact():
    x = np.array([[2 ** 40, 5], [-(2 ** 40), 6], [1, 7]], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    centre = whitening.Centre.of(3, sums)
    exact = [sum((3 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert centre.deviations(x).to_pylist() == [e if e < 2 ** 63 else None for e in exact]
    high, low = whitening._carried(np.array([0]), np.array([2 ** 40 + 3]))
    assert (int(high[0]) << 32) + int(low[0]) == 2 ** 40 + 3
