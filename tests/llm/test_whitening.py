"""Whitening against a dense eigensolver, and the parts of FEAST."""

import math

import numpy as np
import pytest

from changewatch.llm import whitening


def frame(spark, rows):
    """With columns whose names clash with those of results."""
    return spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, embedding array<float>, n int, key string, whitened double")


def dense(rows, most=16):
    """What is expected of good rows: by id the deviations and the absolute whitened values."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    order = order[values[order] > 1e-9 * values.sum()]
    out = (x - sums / n) @ axes[:, order] / np.sqrt(values[order])
    return n, [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x], np.abs(out), values[order] / values.sum()


def compare(spark, good, others=()):
    found = whitening.whiten(frame(spark, [*good, *others])).collect()
    n, deviations, values, shares = dense(good)
    assert len(found) == values.size
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, []).append(r)
    for (ident, _), deviation, row in zip(good, deviations, values):
        own = sorted(by_id[ident], key=lambda r: r.component)
        times = len(own) // len(row)
        own = own[::times]
        assert [r.component for r in own] == list(range(1, len(row) + 1))
        assert all(r.n == n and r.deviation == deviation and r.identity_error < 1e-9 for r in own)
        np.testing.assert_allclose([abs(r.whitened) for r in own], row, atol=1e-8)
        np.testing.assert_allclose([r.explained for r in own], shares, rtol=1e-9)


def test_whitening_against_a_dense_solver(spark):
    draw = np.random.default_rng(1)
    rows = draw.standard_normal((300, 24)) * np.linspace(1, 3, 24)
    good = [(i, row.tolist()) for i, row in enumerate(rows)] + [(1000, rows[3].tolist()), (None, rows[4].tolist())]
    odd = [(2000, None), (2001, []), (2002, [math.nan] * 24), (2003, [math.inf] + [0.0] * 23), (2004, [None] + [1.0] * 23),
           (2005, [1e30] + [0.0] * 23), (2006, [1.0, 2.0])]
    compare(spark, good, odd)


def test_rows_that_do_not_fill_the_space(spark):
    draw = np.random.default_rng(2)
    base = draw.integers(-5, 6, (40, 3)) * 8.0
    rows = [(i, [*row, row[0], 1.0, *row[:2]]) for i, row in enumerate(base.tolist())]  # three dimensions of seven
    compare(spark, rows)


def test_few_rows_and_none(spark):
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # no variance
    assert whitening.whiten(frame(spark, [(1, None)])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0])]).where("false")).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(spark, [(1, [0.0, 3.0]), (2, [1.0, 5.0]), (3, [4.0, 4.5])])


def test_inertia_counts():
    draw = np.random.default_rng(3)
    for size in (1, 2, 7, 30):
        a = draw.standard_normal((size, size))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in (*draw.standard_normal(5), -100, 100, *((values[1:] + values[:-1]) / 2)):
            assert whitening.count_below(a, shift) == (values < shift).sum()
    assert whitening.count_below(np.zeros((3, 3)), 0) == 0
    assert whitening.count_below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0) == 1


@pytest.mark.parametrize("values", [
    [9.0] * 5 + [4.0] * 20 + [1.0] * 10,  # far more than one interval takes can't be told apart
    [10.0 ** -i for i in range(11)] + [0.0] * 9,  # falling fast, then nothing
    list(np.linspace(1, 2, 40)),
])
def test_eigenpairs_of_hard_spectra(spark, values):
    size = len(values)
    basis, _ = np.linalg.qr(np.random.default_rng(4).standard_normal((size, size)))
    a = basis @ np.diag(values) @ basis.T
    found, vectors = whitening.largest_eigenpairs(spark, (a + a.T) / 2, 16)
    want = [v for v in sorted(values, reverse=True)[:16] if v > 2e-12 * sum(values)]
    np.testing.assert_allclose(found, want, rtol=1e-10, atol=1e-14 * max(values) * size)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-12)
    np.testing.assert_allclose(a @ vectors, vectors * found, atol=1e-11 * max(values))


def test_deviations_beyond_what_numpy_holds():
    sums, n = [5 * 10**15 + 3, -(10**16)], 10**9
    x = np.array([[5 * 10**6 + 40, -(10**7) + 7], [10**12, 0]])
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]
