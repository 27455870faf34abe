"""Whitening against numpy's own decompositions and exact whole numbers."""

import numpy as np
import pytest

from burstline.llm import whitening
from burstline.llm.bidiagonal import bidiagonalise, principal, squared_singular_values
from burstline.llm.queries import op11_whitening
from burstline.llm.whitening import COMPONENTS, fit, whiten

SCHEMA = "vec_id long, embedding array<double>"


def rotated(rng, values, rows=40):
    n = len(values)
    left = np.linalg.qr(rng.standard_normal((rows, n)))[0]
    return left * np.array(values, float) @ np.linalg.qr(rng.standard_normal((n, n)))[0]


def matrices():
    rng = np.random.default_rng(0)
    glued = np.diag(np.abs(np.arange(21) - 10.0) + 12) + np.diag(np.ones(20), 1)
    return {
        "normal": rng.standard_normal((200, 64)),
        "graded": rng.standard_normal((90, 20)) * 10.0 ** -np.arange(20),
        "rank three": rng.standard_normal((50, 3)) @ rng.standard_normal((3, 12)),
        "equal columns": np.repeat(rng.standard_normal((50, 5)), 2, axis=1),
        "identity": np.vstack([np.eye(10)] * 3),
        "ties": rotated(rng, [5, 5, 5, 3, 3, 3, 3, 1, 1, 1]),
        "near ties": rotated(rng, 1 + 1e-9 * np.arange(12)),
        "pairs that agree": np.linalg.cholesky(glued + np.diag(np.ones(20), -1)).T,
        "one column": np.ones((4, 1)),
        "fewer rows": rng.standard_normal((3, 9)),
        "large": rng.standard_normal((30, 6)) * 1e150,
        "small": rng.standard_normal((30, 6)) * 1e-150,
        "zero": np.zeros((5, 5)),
    }


@pytest.mark.parametrize("name", matrices())
def test_solver_equals_numpy(name):
    a = matrices()[name]
    r = np.linalg.qr(a, mode="r")
    r = np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])
    expected = np.linalg.svd(a, compute_uv=False)
    rank = int((expected > 1e-13 * expected[0]).sum())
    values, vectors = principal(r, 8)
    k = len(values)
    assert k == min(8, rank)
    assert np.allclose(np.sqrt(values), expected[:k], rtol=1e-13, atol=0)
    assert np.abs(vectors @ vectors.T - np.eye(k)).max(initial=0) < 1e-13
    scale = expected[0] or 1
    for value, v in zip(values, vectors):
        residual = (a / scale).T @ ((a / scale) @ v) - value / scale**2 * v
        assert np.abs(residual).max() < 1e-13 * len(v)


def test_small_values_keep_their_digits():
    b = np.diag(10.0 ** -np.arange(0, 120, 8)) + np.diag(10.0 ** -np.arange(3, 110, 8)[:14], 1)
    found = squared_singular_values(np.diag(b), np.diag(b, 1))
    # The determinant is the product of all values: none may have lost its digits.
    assert np.isclose(np.log10(found).sum(), -2 * np.arange(0, 120, 8).sum(), rtol=1e-12)


def test_bidiagonal_form():
    rng = np.random.default_rng(4)
    r = np.linalg.qr(rng.standard_normal((20, 9)), mode="r")
    diagonal, above, v = bidiagonalise(r)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(v @ v.T, np.eye(9))
    assert np.allclose(v @ b.T @ b @ v.T, r.T @ r)


def assert_whitened(rows, vectors, most=COMPONENTS):
    """``vectors``: id to usable vector, ids unique."""
    ids = sorted(vectors)
    x = np.floor(1024 * np.array([vectors[k] for k in ids], float)).astype(object) + 100_000
    x = np.array([[int(c) for c in row] for row in x], object)
    n, sums = len(x), x.sum(0)
    off = n * x - sums
    centred = off.astype(float) / n
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions.T[::-1]
    by = {}
    for row in rows:
        by.setdefault(row.component, {})[row.vec_id] = row
    k = min(most, int((values > 1e-12 * values[0]).sum()))
    assert sorted(by) == list(range(1, k + 1)) and len(rows) == k * n
    matrix = np.array([[by[c][i].whitened for c in range(1, k + 1)] for i in ids])
    for c in range(1, k + 1):
        for i, place in zip(ids, off):
            row = by[c][i]
            assert row.n == n and row.deviation == sum(int(y) ** 2 for y in place)
            assert np.isclose(row.explained, values[c - 1] / values.sum(), rtol=1e-9)
        gaps = np.abs(np.delete(values, c - 1) - values[c - 1]) / values[0]
        expected = centred @ directions[c - 1] / np.sqrt(values[c - 1])
        if gaps.min(initial=1) > 1e-6:
            off_by = min(np.abs(matrix[:, c - 1] - s * expected).max() for s in (1, -1))
            assert off_by < 1e-7
    flat = matrix - matrix.mean(0)
    error = np.abs(flat.T @ flat / n - np.eye(k)).max()
    assert error < 1e-9 and {round(r.identity_error, 9) for r in rows} == {0.0}
    assert len({r.identity_error for r in rows}) == 1


def test_query_equals_numpy(spark, tables):
    rows = spark.read.parquet(f"{tables}/embeddings.parquet").collect()
    assert_whitened(op11_whitening(spark, tables).collect(), {r.vec_id: r.embedding for r in rows})


@pytest.mark.parametrize("tasks", [1, 7])
def test_unusable_vectors_and_extra_columns(spark, tasks, monkeypatch):
    monkeypatch.setattr(whitening, "_JOINED_BYTES", 1)  # a tree of twos
    rng = np.random.default_rng(2)
    vectors = {k: (rng.standard_normal(5) * [9, 5, 3, 1, 0.5]).tolist() for k in range(60)}
    odd = [None, [], [1.0] * 4, [1.0] * 6, [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5]
    odd += [[float("inf"), 0.0, 0.0, 0.0, 0.0]]
    rows = list(vectors.items()) + [(100 + k, x) for k, x in enumerate(odd)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS vector", "3 AS node")
    assert_whitened(whiten(frame.repartition(tasks)).collect(), vectors)


def test_rows_with_equal_or_no_ids(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.0, 5.0]), (3, [-1.0, 0.5])]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    ids = sorted(r.vec_id or 0 for r in found if r.component == 1)
    assert ids == [0, 1, 1, 3] and {r.n for r in found} == {4}
    same = [r.whitened for r in found if r.vec_id == 1 and r.component == 1]
    assert same[0] == same[1]


def test_tables_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [3.0, 4.0])], [(k, [3.0, 4.0]) for k in range(9)]):
        assert whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    # One direction only.
    rows = [(k, [float(k), 2.0, -float(k)]) for k in range(9)]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in found} == {1} and len(found) == 9
    assert {round(r.explained, 12) for r in found} == {1.0}


def test_large_entries_are_exact_or_refused(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [-(2.0**39), 1.0]), (3, [0.0, 2.0**-11])]
    with pytest.raises(Exception, match="beyond a long"):
        whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    rows = [(1, [2.0**60, 0.0]), (2, [1.0, 1.0])]
    with pytest.raises(Exception, match="too large"):
        whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    rows = [(1, [2.0**17, 0.0]), (2, [-(2.0**17), 1.0]), (3, [0.0, 2.0**-11])]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert_whitened(whiten(frame).collect(), {k: v for k, v in rows})


def test_fit_is_reusable(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.standard_normal(6).tolist()) for k in range(50)]
    known = fit(spark.createDataFrame(rows, SCHEMA), components=3)
    assert known.vectors.shape == (3, 6) and known.n == 50 and known.identity_error < 1e-12
