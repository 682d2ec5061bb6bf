"""Whitening against numpy's eigensolver and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from runway.llm import feast, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors, k=8):
    """{(vec_id, component): (n, deviation, whitened, explained)} of kept (vec_id, vector) rows."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in vectors]
    n, total = len(x), [sum(c) for c in zip(*x)]
    far = np.array([[a - s / n for a, s in zip(v, total)] for v in x])
    matrix = far.T @ far / n
    e, u = np.linalg.eigh(matrix)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for (vec_id, _), v, f in zip(vectors, x, far):
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, total))
        for c in range(min(k, len(e))):
            if e[c] > 1e-12 * e[0]:
                out.append((vec_id, c + 1, n, deviation, f @ u[:, c] / math.sqrt(e[c]), e[c] / np.trace(matrix)))
    return out


def check(rows, want):
    assert len(rows) == len(want)
    got = sorted(rows, key=lambda r: (r["component"], r["deviation"], r["vec_id"] is None, r["vec_id"]))
    want = sorted(want, key=lambda r: (r[1], r[3], r[0] is None, r[0]))
    sign = {}
    for g, w in zip(got, want):
        assert (g["vec_id"], g["component"], g["n"], int(g["deviation"])) == w[:4]
        if abs(w[4]) > 1e-3:
            sign.setdefault(g["component"], math.copysign(1, g["whitened"] * w[4]))
        assert g["whitened"] * sign.get(g["component"], 1) == pytest.approx(w[4], abs=1e-8)
        assert g["explained"] == pytest.approx(w[5], rel=1e-9)
        assert 0 <= g["identity_error"] < 1e-8


@pytest.mark.parametrize("n,d", [(300, 20), (50, 5), (9, 30), (2, 3)])
def test_equals_plain_version(spark, n, d):
    r = np.random.default_rng(n)
    v = (r.standard_normal((n, d)) * np.linspace(3, .1, d)).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    out = whiten.whiten(spark.createDataFrame([(*x, 1) for x in rows], SCHEMA).repartition(5))
    check(out.collect(), plain(rows))


def test_odd_vectors_take_no_part(spark):
    r = np.random.default_rng(4)
    good = [(i, r.standard_normal(6).tolist()) for i in range(40)]
    good += [(None, good[0][1]), (3, good[3][1])]
    odd = [(100, None), (101, []), (102, [1.0] * 5 + [None]), (103, [1.0] * 5 + [float("nan")]), (104, [float("inf")] + [0.0] * 5), (105, [0.0] * 7),
           (106, [-float("inf")] * 6), (107, [1e30] + [0.0] * 5)]
    df = spark.createDataFrame([(*x, None) for x in odd + good], SCHEMA).withColumnsRenamed({"label": "x"})
    check(whiten.whiten(df).collect(), plain(good))


def test_large_entries_stay_exact(spark):
    r = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in r.standard_normal(4) * 4e8]) for i in range(30)]
    check(whiten.whiten(spark.createDataFrame([(*x, 1) for x in rows], SCHEMA)).collect(), plain(rows))


def test_no_variance_or_no_vectors(spark):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 5):
        out = whiten.whiten(spark.createDataFrame(rows, SCHEMA))
        assert out.count() == 0 and "identity_error" in out.columns


@pytest.mark.parametrize("eigenvalues", [[3.0], [1, 1], [0] * 5, [5, 5, 5, 1, 0, 0], [1] * 30, range(40), [1, 1 - 1e-9, 1 - 2e-9] + [.5] * 17, [1e12] + [1e-3] * 11,
                                         [2 ** -k for k in range(60)], [-1, -2, -3, 4]])
def test_feast(eigenvalues):
    r = np.random.default_rng(1)
    n = len(eigenvalues)
    q, _ = np.linalg.qr(r.standard_normal((n, n)))
    a = (q * np.array(eigenvalues, dtype=float)) @ q.T
    a = (a + a.T) / 2
    size = max(1.0, np.abs(a).max())
    e, u = feast.largest(a, 8)
    assert np.abs(e - np.sort(np.linalg.eigvalsh(a))[::-1][:8]).max() < 1e-13 * size * n
    assert np.abs(a @ u - u * e).max() < 1e-12 * size and np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13


def test_inertia():
    r = np.random.default_rng(2)
    a = r.standard_normal((50, 50))
    a = a + a.T
    d, o = feast.tridiagonal(a)
    w = np.linalg.eigvalsh(a)
    for s in np.linspace(-25, 25, 101):
        assert feast.above(d, o, s) == (w > s).sum()
