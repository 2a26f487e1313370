import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from weblens.llm.whitening import bidiagonalise, dqds, singular_pairs, whitened_components

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def compare(df, expected_rows, tolerance=1e-9):
    """The result of ``df`` against eigenvectors of the covariance."""
    vectors = [(i, np.floor(256 * np.array(v, dtype=float)).astype(np.int64)) for i, v in expected_rows]
    fit = np.unique(np.array([x for _, x in vectors]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    rows = df.collect()
    k = max((r["component"] for r in rows), default=0)
    assert len(rows) == len(vectors) * k
    by_row = {}
    for r in rows:
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    sign = np.zeros(k)
    for i, x in vectors:
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        found = by_row[i, exact]
        assert sorted(found) == list(range(1, k + 1))
        want = (x - sums / n) @ directions[:, :k] / np.sqrt(values[:k])
        for c in range(k):
            r = found[c + 1].pop()
            assert r["n"] == n and r["identity_error"] < 1e-9
            assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-10)
            if abs(want[c]) > 1e-3 and not sign[c]:
                sign[c] = np.sign(r["whitened"] * want[c])
            assert abs(r["whitened"] - (sign[c] or 1) * want[c]) < tolerance * 100
    return k


def matrices():
    rng = np.random.default_rng(3)
    turn = [np.linalg.qr(rng.normal(size=(24, 24)))[0] for _ in range(2)]
    yield from (rng.normal(size=(n, n)) for n in (1, 2, 3, 17, 64))
    yield np.zeros((6, 6))
    yield np.eye(7)
    yield turn[0] @ np.diag([3.0] * 5 + [2.0] * 5 + [1.0] * 14) @ turn[1]
    yield turn[0] @ np.diag(10.0 ** -np.arange(24)) @ turn[1]
    yield np.diag(10.0 ** -np.arange(24.0)[::-1]) @ turn[1]
    yield rng.normal(size=(24, 4)) @ rng.normal(size=(4, 24))
    w = np.diag(np.abs(np.arange(21) - 10.0) + 2.2) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield np.linalg.cholesky(w).T


@pytest.mark.parametrize("matrix", list(matrices()), ids=lambda m: str(len(m)))
def test_solver_equals_a_dense_one(matrix):
    a, b, p = bidiagonalise(matrix)
    want = np.linalg.svd(matrix, compute_uv=False)
    scale = max(1e-300, want[0])
    assert np.abs(np.sqrt(np.maximum(0, dqds(a, b))) - want).max() < 1e-13 * scale + 1e-300
    values, vectors = singular_pairs(a, b, 6)
    directions = p @ vectors
    assert np.abs(directions.T @ directions - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix.T @ (matrix @ directions) - directions * values).max() <= 1e-13 * scale ** 2 + 1e-300


def test_small_values_keep_their_digits():
    a = 10.0 ** -np.arange(0.0, 20.0, 2)
    b = a[:-1] / 3
    want = np.sort(dqds(a, b))
    # Scaling rows scales nothing it should not: the product of the values is the determinant.
    assert np.prod(np.sqrt(want)) == pytest.approx(np.prod(a), rel=1e-13)


def test_random_bidiagonals():
    rng = np.random.default_rng(8)
    for t in range(200):
        n = int(rng.integers(2, 12))
        a, b = (rng.normal(size=m) * 10.0 ** rng.integers(-8, 8, size=m) for m in (n, n - 1))
        if t % 3 == 0:
            a[rng.integers(n)] = 0
        if t % 5 == 0:
            b[rng.integers(n - 1)] = 0
        want = np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False)
        assert np.abs(np.sqrt(np.maximum(0, dqds(a, b))) - want).max() < 1e-13 * want[0]


def test_equals_eigenvectors_with_repeats(spark):
    rng = random.Random(1)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.1 * (d + 1)))) for d in range(6)]) for i in range(300)]
    rows += [(i + 300, rows[0][1]) for i in range(400)] + [(5, rows[5][1])]  # more copies than others, and a repeated row
    df = spark.createDataFrame(rows, SCHEMA).repartition(40)
    assert compare(whitened_components(df), rows) == 4


def test_given_table(spark):
    df = spark.read.parquet(os.path.join(SF_DIR, "embeddings.parquet"))
    assert compare(whitened_components(df), [(r["vec_id"], r["embedding"]) for r in df.collect()]) == 4


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -0.25]), (2, [0.0, -0.0, 0.0]), (None, [0.3, 0.1, 0.7]), (4, [0.5, 1.0, -0.25]), (4, [0.5, 1.0, -0.25])]
    bad = [(5, None), (6, []), (7, [1.0, None, 2.0]), (8, [nan, 0.0, 0.0]), (9, [0.0, inf, 0.0]), (10, [1.0, 2.0])]
    df = spark.createDataFrame(good + bad, SCHEMA)
    for name in ("_x", "part", "value", "component", "n", "label"):
        df = df.withColumn(name, F.lit("other"))
    out = whitened_components(df)
    assert out.columns[0] == "vec_id" and {"_x", "part", "value", "label"} < set(out.columns)
    assert compare(out, [(i, [float(np.float32(c)) for c in v]) for i, v in good]) == 2  # three points span a plane


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]])
def test_nothing_to_fit(spark, rows):
    out = whitened_components(spark.createDataFrame(rows, SCHEMA))
    assert out.count() == 0 and "identity_error" in out.columns


def test_beyond_bigint(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]
    got = whitened_components(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")).collect()
    assert {r["vec_id"] for r in got if r["deviation"] is None} == {1, 2} and all(np.isfinite(r["whitened"]) for r in got)
