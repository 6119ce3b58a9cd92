"""Embedding whitening against numpy's eigenvectors and exact sums."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakelayer.llm import whitening


def _quantised(vectors):
    return np.array([[math.floor(float(np.float32(c)) * 1024) + 100000 for c in v] for v in vectors])


def _whiten(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).withColumn("n", F.lit(1))
    return whitening.whiten(df).collect()


def _check(got, rows):
    x = _quantised([v for _, v in rows])
    n, sums = len(x), x.sum(0)
    a = x - sums / n
    e, q = np.linalg.eigh(a.T @ a / n)
    e, q = e[::-1], q[:, ::-1]
    k = int((e[:8] > 1e-9 * max(e[0], 1)).sum())
    assert len(got) == n * k
    by = {(r["vec_id"], r["component"]): r for r in got}
    for j in range(k):
        want = a @ q[:, j] / math.sqrt(e[j])
        have = np.array([by[i, j + 1]["whitened"] for i, _ in rows])
        assert np.allclose(have * np.sign(want @ have), want, atol=1e-8)
        assert by[rows[0][0], j + 1]["explained"] == pytest.approx(e[j] / e.sum(), rel=1e-9)
    for (i, _), row in zip(rows, x):
        exact = sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums))
        assert all((by[i, j + 1]["deviation"], by[i, j + 1]["n"]) == (exact, n) for j in range(k))
    assert all(r["identity_error"] < 1e-8 for r in got)


def test_whitening_is_the_eigenvectors(spark):
    r = np.random.default_rng(0)
    rows = [(i, [float(c) for c in r.normal(size=12) * np.arange(1, 13)]) for i in range(150)]
    bad = [(1000, None), (1001, [None] * 12), (1002, [1.0] * 11 + [float("nan")]), (1003, [float("-inf")] * 12), (1004, []),
           (1005, [1.0] * 11), (1006, [1e30] * 12)]
    _check(_whiten(spark, rows + bad), rows)


def test_dependent_dimensions_have_fewer_components(spark):
    rows = [(i, [float(i % 3), float(i % 5), 1.0, float(i % 3) * 2]) for i in range(30)]
    _check(_whiten(spark, rows), rows)


def test_equal_eigenvalues_are_all_found(spark):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(np.vstack([np.eye(10), -np.eye(10)]))]
    got = _whiten(spark, rows)
    assert len(got) == 20 * 8
    assert {round(r["explained"], 9) for r in got} == {0.1} and all(r["identity_error"] < 1e-8 for r in got)


def test_repeated_null_ids_and_empty_tables(spark):
    assert _whiten(spark, []) == [] and _whiten(spark, [(1, [1.0, 2.0])]) == []
    got = _whiten(spark, [(None, [1.0, 2.0]), (None, [2.0, 1.0]), (7, [5.0, 5.0]), (7, [5.0, 5.0])])
    assert sorted(r["vec_id"] or 0 for r in got) == [0, 0, 0, 0, 7, 7, 7, 7]


def test_deviations_beyond_64_bits_are_exact_or_null():
    centre = whitening.Centre(10**7, [5 * 10**12 + 3, 10**12])
    x = np.array([[500_001, 100_000], [500_000 + 10**6, 100_000]])
    exact = [(10**7 * 500_001 - centre.sums[0]) ** 2, (10**7 * (500_000 + 10**6) - centre.sums[0]) ** 2]
    assert whitening._deviations(x, centre) == [exact[0], None] and exact[1] > 2**63


def test_stops_early_only_when_converged():
    r = np.random.default_rng(1)
    a = r.normal(size=(400, 60)) * np.array([1000, 500, 200] + [1e-3] * 57)
    calls = []

    def product(q):
        calls.append(1)
        u = a @ q
        return a.T @ u, float(u @ u)

    v, s = whitening.bidiagonalise(product, 60, 2)
    want = np.linalg.svd(a)
    assert len(calls) < 60 and np.allclose(s[:2], want[1][:2], rtol=1e-12)
    assert np.allclose(np.abs(v[:2] @ want[2][:2].T), np.eye(2), atol=1e-12)
