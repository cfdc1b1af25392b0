"""Whitening against exact rational arithmetic and a dense eigensolver."""

from fractions import Fraction

import numpy as np

from flowlens.llm import whitening as X

COLS = "vec_id bigint, embedding array<float>, x string, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], COLS)


def vectors(seed, n, d):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n, d)) * np.linspace(2.0, 0.1, d) + r.normal(size=d)
    return [[float(np.float32(c)) for c in v] for v in base]


def exact(rows):
    """Fit list, sums, scatter by plain integers."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    xs = [(i, tuple(int(np.floor(64 * float(c))) + X.SHIFT for c in v)) for i, v in good]
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    m = [[n * sum(x[i] * x[j] for x in fit) - s[i] * s[j] for j in range(d)] for i in range(d)]
    return xs, fit, s, m


def test_whole(spark):
    rows = list(enumerate(vectors(1, 60, 20)))
    rows += [(100 + i, v) for i, v in rows[:30]] + [(None, rows[0][1]), (5, rows[1][1]), (200, None), (201, []),
                                                   (202, [1.0] * 19), (203, [float("nan")] * 20),
                                                   (204, [1.0] * 19 + [float("inf")]), (205, [None] + [1.0] * 19)]
    xs, fit, s, m = exact([r for r in rows if r[1] is None or len(r[1]) != 19])
    got = X.whiten(frame(spark, rows)).collect()
    n = len(fit)
    assert len(got) == 16 * len(xs) and {r.n for r in got} == {n}
    value, vec = np.linalg.eigh(np.array([[float(Fraction(v, n * n)) for v in r] for r in m]))
    value, vec = value[::-1], vec[:, ::-1]
    dev, expected = {}, {}
    for i, x in xs:
        off = [n * c - t for c, t in zip(x, s)]
        dev.setdefault(i, set()).add(sum(o * o for o in off))
        expected.setdefault(i, []).append(np.array([o / n for o in off]) @ vec / np.sqrt(np.maximum(value, 1e-300)))
    sign = {}
    for r in got:
        assert r.deviation in dev[r.vec_id] and r.identity_error < 1e-9
        assert abs(r.explained / (value[r.component - 1] / value.sum()) - 1) < 1e-9
        if len(expected[r.vec_id]) == 1:
            want = expected[r.vec_id][0][r.component - 1]
            assert abs(abs(want) - abs(r.whitened)) < 1e-8
            if abs(want) > 1e-3:
                assert sign.setdefault(r.component, want * r.whitened > 0) == (want * r.whitened > 0)


def test_polynomial_roots(spark):
    m = [[2, 1, 0], [1, 2, 0], [0, 0, 3]]  # eigenvalues 1, 3, 3
    poly = X.characteristic(spark, m)
    assert poly == [-9, 15, -7, 1]
    assert [X.above(poly, a) for a in (0, 1, 2, 3)] == [3, 2, 2, 0]
    found = X.roots(spark, poly, 3, 8)
    assert [abs(a / 2 ** t - v) < 1e-12 for (a, t), v in zip(found, (3, 3, 1))] == [True] * 3
    assert X.clusters(found) == [[0, 1], [2]]
    v = np.array(X.components(spark, m, found))
    assert np.abs(v @ v.T - np.eye(3)).max() < 1e-14 and np.abs(np.array(m) @ v.T - v.T * [3, 3, 1]).max() < 1e-13


def test_close_eigenvalues():
    """Vectors to double precision where a floating-point solver has lost half of it."""
    e = 1 << 40
    m = [[2 * e + 1, 1, 0], [1, 2 * e, 0], [0, 0, e]]
    a, t = X.root(poly3(m), 1, 8 * e)
    v = X.null_space(m, a, t, 1)[0]
    # eigenvector of [[1, 1], [1, 0]] for the golden ratio
    g = (1 + 5 ** 0.5) / 2
    want = np.array([g, 1, 0]) / np.hypot(g, 1)
    assert np.abs(np.abs(v) - want).max() < 1e-15


def poly3(m):
    """Characteristic polynomial of a 3 x 3 matrix."""
    (a, b, c), (d, e, f), (g, h, i) = m
    minors = a * e - b * d + a * i - c * g + e * i - f * h
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    return [-det, minors, -(a + e + i), 1]


def test_large_entries(spark):
    rows = [(k, [float(3e30 * (k % 3)), float(k), -1e9 * (k * k % 7)]) for k in range(9)]
    xs, fit, s, m = exact(rows)
    held = X.integers(frame(spark, rows)).collect()
    assert max(abs(v) for r in held for v in r.x) == 1 << 62
    small = [(k, [1e6 * k, float(k * k), -1e9 * k]) for k in range(9)]
    _, fit, s, m = exact(small)
    n, sums, got = X.scatter(X.integers(frame(spark, small)).select("x"))
    assert n == 9 and got == m and [v + n * X.SHIFT for v in sums] == s
    assert X.whiten(frame(spark, rows)).count() == 9 * 3


def test_no_spread(spark):
    assert X.whiten(frame(spark, [])).count() == 0
    assert X.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert X.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert X.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, None)])).count() == 2  # rank one
    assert X.whiten(frame(spark, [(1, None), (2, [])])).columns[0] == "vec_id"
