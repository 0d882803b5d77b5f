"""Whitening against a covariance's eigenvectors and exact sums in plain Python."""

import math
from fractions import Fraction

import numpy as np

from wayweave.llm import whitening


def brute(vectors, components):
    """(x, n, S, eigenvalues, components) through the covariance, which the operator never forms."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums, strict=True)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return x, n, sums, values[order], axes[:, order].T, values.sum(), centred


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    out = rng.normal(size=(n, d)) @ (rng.normal(size=(d, d)) * 2.0 ** -np.arange(d)[:, None])
    return (out * 8).astype(np.float32).astype(float).tolist()


def test_whitening_against_covariance(spark):
    good = vectors(400, 7, 1)
    rows = [(i, v, 1, 2) for i, v in enumerate(good)]
    rows += [(900, None, 1, 2), (901, [1.0] * 6 + [None], 1, 2), (902, [float("nan")] * 7, 1, 2), (903, [float("inf")] * 7, 1, 2), (904, [], 1, 2), (905, [1.0] * 3, 1, 2), (906, [1e30] * 7, 1, 2)]
    rows += [(None, good[0], 1, 2), (7, good[7], 1, 2)]
    used = [v for i, v, _, _ in rows if i is None or i < 900]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int, part int").repartition(19)
    x, n, sums, values, axes, trace, centred = brute(used, 5)
    got = whitening.whiten(table, components=5).collect()
    assert len(got) == 5 * n == 5 * 402
    assert {(r.n, r.identity_error) for r in got} == {(n, got[0].identity_error)} and got[0].identity_error < 1e-9
    want = {}
    for (i, *_), row, c in zip([r for r in rows if r[0] is None or r[0] < 900], x, centred, strict=True):
        want.setdefault(i, (sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)), c))
    for k in range(5):
        mine = [r for r in got if r.component == k + 1]
        flat = np.array([want[r.vec_id][1] @ axes[k] / math.sqrt(values[k]) for r in mine])
        found = np.array([r.whitened for r in mine])
        assert min(np.abs(found - flat).max(), np.abs(found + flat).max()) < 1e-7
        assert all(r.deviation == want[r.vec_id][0] for r in mine)
        assert abs(mine[0].explained * trace / values[k] - 1) < 1e-9


def test_one_common_vector_and_flat_directions(spark):
    """A vector that most rows share, and directions without deviation, which are no components."""
    good = [[a, 2 * a, b, 5.0] for a, b in np.random.default_rng(3).normal(size=(40, 2)).tolist()]
    good = [[math.floor(64 * v[0]) / 64, 2 * math.floor(64 * v[0]) / 64, v[2], 5.0] for v in good] + [[0.5, 1.0, 0.25, 5.0]] * 200
    table = spark.createDataFrame(list(enumerate(good)), "vec_id long, embedding array<double>").repartition(11)
    got = whitening.whiten(table).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 480 and got[0].identity_error < 1e-9
    assert abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-9


def test_large_numbers_stay_exact(spark):
    big = 2.0**40
    good = [[big, 1.0], [-big, 2.0], [big / 2, 3.0]]
    table = spark.createDataFrame(list(enumerate(good)), "vec_id long, embedding array<double>")
    x, n, sums, *_ = brute(good, 2)
    got = {r.vec_id: r.deviation for r in whitening.whiten(table).collect()}
    for i, row in enumerate(x):
        exact = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        assert got[i] == (exact if exact < 2**63 else None)


def test_no_component(spark):
    shape = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whiten(spark.createDataFrame(rows, shape))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.collect() == []
