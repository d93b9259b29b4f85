"""Whitening against plain linear algebra over Python integers, and hard eigenproblems."""

import math
from fractions import Fraction

import numpy as np
import pytest

from loginwatch.llm import whitening
from loginwatch.llm.whitening import _clusters, _products, eigenpairs, whitened

from .cases import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow_whitened(rows, components=16):
    """``{(row, component): ...}`` up to signs, from exact covariances."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept]
    fit = sorted(set(map(tuple, xs)))
    n, d = len(fit), len(fit[0])
    sums = [sum(col) for col in zip(*fit)]
    centred = [[Fraction(n * x - s, n) for x, s in zip(row, sums)] for row in fit]
    v = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for (vec_id, _), x in zip(kept, xs):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        y = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ vectors / np.sqrt(values)
        out.append((vec_id, n, deviation, y))
    return out, values / np.trace(v)


def got_by_row(frame):
    rows = {}
    for r in frame.collect():
        rows.setdefault((r["vec_id"], r["deviation"], r["n"]), {})[r["component"]] = r
    return rows


def test_given_table_equals_exact_algebra(spark):
    data = table(spark, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in data.select("vec_id", "embedding").collect()]
    # A third of the entries keeps the exact fractions of the slow version affordable.
    rows = [(i, v[:20]) for i, v in rows]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    want, explained = slow_whitened(rows)
    got = got_by_row(whitened(frame))
    assert len(got) == len(want)
    signs = None
    for vec_id, n, deviation, y in want:
        found = got[vec_id, deviation, n]
        assert sorted(found) == list(range(1, 17))
        mine = np.array([found[k]["whitened"] for k in range(1, 17)])
        signs = np.sign(mine * y) if signs is None else signs
        assert np.allclose(mine * signs, y, atol=1e-8)
        assert np.allclose([found[k]["explained"] for k in range(1, 17)], explained, rtol=1e-12)
        assert found[1]["identity_error"] < 1e-10


def test_whole_given_table(spark):
    data = table(spark, "embeddings")
    rows = whitened(data).collect()
    assert len(rows) == 16 * data.count()
    assert {r["component"] for r in rows} == set(range(1, 17)) and len({(r["n"], r["identity_error"]) for r in rows}) == 1


def test_copies_are_fitted_once_but_all_returned(spark):
    vectors = [[0.0, 1.0, 0.5], [1.0, 0.0, 0.25], [2.0, 1.0, -1.0], [0.5, 3.0, 1.0], [1.5, 1.5, 2.0]]
    rows = [(i, vectors[i % 5]) for i in range(5)] + [(9, vectors[0])] * 40 + [(None, [0.0 + 1e-6, 1.0, 0.5])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    want, _ = slow_whitened(rows)
    got = whitened(frame).collect()
    assert len(got) == 3 * len(rows) and {r["n"] for r in got} == {5} == {w[1] for w in want}
    assert sorted(r["deviation"] for r in got) == sorted(3 * [w[2] for w in want])
    assert all(r["identity_error"] < 1e-12 for r in got)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [-inf, 0.0]), (6, []), (7, [1.0, 2.0, 3.0]),
        (8, [0.0, 1.0]), (9, [1.0, 0.5]), (None, [0.25, 0.25]), (11, [0.0, 1.0]),
    ]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    clashing = frame.withColumnRenamed("label", "n").selectExpr("*", "1 AS component", "'a' AS whitened", "0 AS x")
    assert {r["vec_id"] for r in whitened(clashing).collect()} == {8, 9, None, 11}
    assert whitened(frame.where("vec_id < 6")).count() == 0
    assert whitened(frame.where("false")).count() == 0
    assert whitened(frame.where("vec_id IN (8, 11)")).count() == 0  # all alike: no variance
    huge = spark.createDataFrame([(1, [3e38, 1.0], 0), (2, [-3e38, 0.5], 0), (3, [0.0, 7.0], 0)], SCHEMA)
    # The third lies at the mean of the first entries; the others are too far out for a long.
    assert {(r["vec_id"], r["deviation"]) for r in whitened(huge).collect()} == {(1, None), (2, None), (3, 640_000)}


def test_products_are_exact_for_any_size():
    for top in (9, 1 << 20, 1 << 40):
        y = np.random.default_rng(top).integers(-top, top, (50, 4))
        wide = y.astype(object)
        assert (_products(y) == wide.T @ wide).all()


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(4):  # orthogonal to extended precision
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    a = (q * np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize("values", [
    np.linspace(40, 1, 40), 10.0 ** -np.linspace(0, 7, 30),
    np.concatenate([[5, 5, 5], np.linspace(4, 1, 20)]),
    np.concatenate([2 + 1e-10 * np.arange(6)[::-1], np.linspace(1, 0.1, 12)]),
    np.concatenate([2 + 1e-6 * np.arange(4)[::-1], 1 + 1e-11 * np.arange(5)[::-1]]),
    np.zeros(4), np.ones(7),
])
def test_clustered_and_spread_spectra(values):
    a, q = spectrum(values)
    found, x = eigenpairs(a)
    assert np.allclose(found, values, rtol=1e-13, atol=1e-17 + 1e-15 * max(values))
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-15 * len(values)
    residual = a @ x - x * found
    assert np.abs(residual).max() <= 4e-16 * max(values)
    # Single vectors where gaps allow; a double cannot hold more than the matrix decides.
    for i in range(len(values)):
        gap = min((abs(values[i] - v) for j, v in enumerate(values) if j != i), default=0)
        if gap > 1e-7:
            assert 1 - abs(float(q[:, i] @ x[:, i])) < 1e-15


def test_single_precision_alone_would_not_do():
    a, _ = spectrum(np.concatenate([2 + 1e-6 * np.arange(4)[::-1], np.linspace(1, 0.1, 12)]))
    coarse = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    found, x = eigenpairs(a)
    assert np.abs(a @ x - x * found).max() < 1e-15 < 1e-8 < np.abs(a @ coarse - coarse * np.einsum("ij,ij->j", coarse, a @ coarse)).max()


def test_clusters():
    assert [list(c) for c in _clusters(np.array([5.0, 4.9, 3, 2, 1.95, 1.9]), 0.2)] == [[0, 1], [3, 4, 5]]
    assert whitening.COMPONENTS == 16
