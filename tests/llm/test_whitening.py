import math

import numpy as np
import pytest

from faresettle.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, ids int, n string"


def make(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, v if v is None else [None if c is None else float(c) for c in v], 0, "x", 1, "n") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def expected(vectors, components=32):
    x = np.floor(64 * np.asarray(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(0)
    centred = (n * x - total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [sum(int(d) ** 2 for d in row) for row in n * x - total]
    return deviation, centred @ vectors / np.sqrt(values), values / (np.square(centred).sum() / n)


def check(out, ids, vectors, components=32):
    deviation, white, explained = expected(vectors, components)
    rows = {(r["vec_id"], r["component"]): r for r in out}
    keep = white.shape[1]
    assert set(rows) == {(i, k + 1) for i in ids for k in range(keep)}
    got = np.array([[rows[i, k + 1]["whitened"] for k in range(keep)] for i in ids])
    signs = np.sign((got * white).sum(0))
    assert np.abs(got - white * signs).max() < 1e-6
    assert [rows[i, 1]["deviation"] for i in ids] == deviation
    assert {r["n"] for r in out} == {len(ids)}
    for k in range(keep):
        assert math.isclose(rows[ids[0], k + 1]["explained"], explained[k], rel_tol=1e-9)
    assert {r["identity_error"] for r in out} == {out[0]["identity_error"]} and out[0]["identity_error"] < 1e-8


@pytest.mark.parametrize("block", [7, 8192])
def test_table_equals_eigenvectors_of_the_covariance(sf, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK", block)
    table = sf("embeddings", "0.01")
    held = table.collect()
    check(whitening.whiten(table).collect(), [r["vec_id"] for r in held], [r["embedding"] for r in held])


def test_variances_far_apart_and_few_dimensions(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((300, 5)) * [3000, 200, 30, 4, 0.5]).tolist()
    check(whitening.whiten(make(spark, vectors)).collect(), list(range(300)), vectors, 5)


def test_equal_variances_are_all_found(spark):
    """A cross in four dimensions: one variance, four times."""
    vectors = [[s * (d == k) for d in range(4)] for k in range(4) for s in (1, -1)]
    out = whitening.whiten(make(spark, vectors)).collect()
    assert len(out) == 32
    assert all(math.isclose(r["explained"], 0.25, rel_tol=1e-9) and r["identity_error"] < 1e-9 for r in out)


def test_wide_vectors_end_when_converged(spark, monkeypatch):
    monkeypatch.setattr(whitening, "WHOLE", 16)
    steps = []
    product = whitening.Centred.there_and_back
    monkeypatch.setattr(whitening.Centred, "there_and_back", lambda self, y: steps.append(1) or product(self, y))
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((400, 80)) * (100 * 0.7 ** np.arange(80) + 0.05)).tolist()
    check(whitening.whiten(make(spark, vectors), components=6).collect(), list(range(400)), vectors, 6)
    assert len(steps) < 60


def test_rows_of_every_kind(spark):
    vectors = [
        [1, 2, 0], [0, 1, 5], [3, 1, 1], [3, 1, 1], [2, 7, 1.5], None, [1, None, 2], [1, float("nan"), 2], [1, float("inf"), 2], [1e38, 0, 0], [], [1, 2], [0, 0, 0],
    ]
    ids = [10, 11, 12, 12, None, 5, 6, 7, 8, 9, 1, 2, 3]
    out = whitening.whiten(make(spark, vectors, ids)).collect()
    good = [0, 1, 2, 3, 4, 12]
    deviation, white, _ = expected([vectors[k] for k in good])
    assert sorted((r["vec_id"] is None, r["vec_id"], r["component"]) for r in out if r["vec_id"] is not None) == sorted(
        (False, ids[k], c) for k in good for c in (1, 2, 3) if ids[k] is not None
    )
    assert sum(r["vec_id"] is None for r in out) == 3
    assert sorted(r["deviation"] for r in out) == sorted(d for d in deviation for _ in range(3))
    assert {r["n"] for r in out} == {6}


@pytest.mark.parametrize("vectors", [[], [None, []], [[1, 2, 3]], [[1, 2], [1, 2]]])
def test_no_variance_gives_no_rows(spark, vectors):
    assert whitening.whiten(make(spark, vectors)).collect() == []


def test_deviation_beyond_a_long_is_null():
    x = np.array([[3_000_000_000], [0], [1]])
    assert whitening._deviations(x, 2, np.array([0])) == [None, 0, 4]
    assert whitening._deviations(x, 1, np.array([0])) == [9 * 10**18, 0, 1]
