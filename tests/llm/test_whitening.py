"""Whitening: odd rows, and the eigenvectors of the whole covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening as W
from tidemark.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, x int, block string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, v, 1, "b") for i, v in zip(ids, vectors, strict=True)]
    return prepare(spark).createDataFrame(rows, SCHEMA).repartition(3)


def usable(v, width):
    return v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)


def check(df, components=4, width=None):
    source = df.collect()
    width = width or max(len(r.embedding) for r in source if r.embedding is not None)
    kept = [r for r in source if usable(r.embedding, width)]
    whole = [tuple(math.floor(256 * float(c)) for c in r.embedding) for r in kept]
    fit = sorted(set(whole))
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1].T
    rank = int((values > 1e-9 * max(values.sum(), 1e-300)).sum())
    found = W.whiten(df, components).collect()
    k = min(components, rank)
    assert len(found) == len(kept) * k
    by_id = {}
    for r in found:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for row, x in zip(kept, whole, strict=True):
        exact = [n * c - s for c, s in zip(x, sums, strict=True)]
        for i in range(k):
            (r, *same) = by_id[row.vec_id, i + 1]
            if not same:
                assert (r.n, int(r.deviation)) == (n, sum(c * c for c in exact))
                assert abs(r.explained - values[i] / values.sum()) < 1e-10
                assert r.identity_error < 1e-8
            gap = min((abs(values[i] - values[j]) for j in range(len(values)) if j != i), default=1)
            if same or gap < 1e-6 * values[0]:
                continue  # any basis of equal deviations will do
            want = float(np.array(exact) / n @ vectors[i]) / math.sqrt(values[i])
            if abs(want) > 1e-6:
                signs.setdefault(i, set()).add(np.sign(r.whitened * want))
            assert abs(abs(r.whitened) - abs(want)) < 1e-7 * max(1, abs(want))
    assert all(len(s) == 1 for s in signs.values())
    return found


def test_against_all_eigenvectors(spark):
    draw = np.random.default_rng(1)
    spread = np.array([5, 4.9, 3, 2, 1.9, 1, 0.5, 0.2])
    vectors = (draw.standard_normal((300, 8)) * spread / 4 + draw.standard_normal(8)).tolist()
    vectors += vectors[:40] + [vectors[0]] * 100
    vectors += [None, [None] * 8, [1.0] * 7, [math.nan] + [0.0] * 7, [0.0] * 7 + [math.inf], []]
    check(table(spark, vectors), width=8)


def test_rank_ties_and_single(spark):
    draw = np.random.default_rng(2)
    low = (draw.integers(-3, 4, (60, 2)) @ draw.integers(-2, 3, (2, 6))).astype(float).tolist()
    check(table(spark, low))
    corners = [[s / 4 * (i == j) for j in range(5)] for i in range(5) for s in (-1, 1)]
    found = check(table(spark, corners))  # five equal deviations
    assert {r.component for r in found} == {1, 2, 3, 4}
    assert W.whiten(table(spark, [[1.0, 2.0]] * 3)).count() == 0
    assert W.whiten(table(spark, [[1.0, 2.0]])).count() == 0
    assert W.whiten(table(spark, [[]])).count() == 0
    assert W.whiten(table(spark, [None, [1.0]]).limit(0)).count() == 0
    check(table(spark, [[0.5], [1.5], [-1.0]], [None, None, 7]), width=1)


def test_many_dimensions_stop_early(spark):
    draw = np.random.default_rng(3)
    factors = draw.standard_normal((4, 200)) * np.array([[9], [7], [5], [3]])
    vectors = draw.standard_normal((400, 4)) @ factors + 0.01 * draw.standard_normal((400, 200))
    passes = []
    x = vectors - vectors.mean(0)

    def product(z, w):
        passes.append(1)
        r = x @ z
        return float(r @ r), (x @ w.T).T @ r, x.T @ r

    found, values = W.bidiagonalise(product, 200, float((x * x).sum()), 4)
    want = np.linalg.svd(x)
    assert len(passes) < 40
    assert np.allclose(values[:4], want.S[:4], rtol=1e-12)
    assert np.allclose(np.abs(found[:4] @ want.Vh[:4].T), np.eye(4), atol=1e-10)


@pytest.mark.parametrize("top", [1e3, 1e13])
def test_exact_sums_of_large_entries(spark, top):
    draw = np.random.default_rng(4)
    vectors = (draw.standard_normal((40, 3)) * top).tolist()
    check(table(spark, vectors), 2)
