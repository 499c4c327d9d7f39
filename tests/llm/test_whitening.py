import math
from fractions import Fraction

import numpy as np
import pytest

from framelark.llm import whitening


def plain(vectors, k=4):
    """Grid, distinct vectors, covariance, eigenvectors, by numpy."""
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    v = (fit - s / n).T @ (fit - s / n) / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    return x, n, s, e, (x - s / n) @ w / np.sqrt(e), e / np.trace(v)


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(400, 9)) * np.arange(1, 10) / 9).round(3)
    vectors[200:300] = vectors[7]  # copies count once
    bad = [None, [1.0] * 8 + [None], [1.0] * 8 + [math.nan], [1.0] * 8 + [math.inf], [], [1.0] * 8]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)] + [(1000 + i, v, "y") for i, v in enumerate(bad)] + [(None, vectors[3].tolist(), "z")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string").repartition(7)
    got = whitening.report(table).toPandas()
    x, n, s, e, white, explained = plain(vectors)
    assert len(got) == 4 * 401 and (got.n == n).all() and got.identity_error.max() < 1e-12
    want = dict(enumerate(((n * x - s) ** 2).sum(1).tolist()))
    for k in range(4):
        part = got[(got.component == k + 1) & got.vec_id.notna()].set_index("vec_id").sort_index()
        sign = np.sign((part.whitened.to_numpy() * white[:, k]).sum())
        assert abs(part.whitened.to_numpy() * sign - white[:, k]).max() < 1e-9
        assert abs(part.explained - explained[k]).max() < 1e-12
        assert part.deviation.tolist() == [want[i] for i in part.index]
    assert got.vec_id.isna().sum() == 4


def exact_polynomial(m):
    """Faddeev and LeVerrier's recurrence in fractions."""
    d = len(m)
    a = [[Fraction(v) for v in row] for row in m]
    mul = lambda p, q: [[sum(p[i][k] * q[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
    out, b = [Fraction(1)], [[Fraction(i == j) for j in range(d)] for i in range(d)]
    for k in range(1, d + 1):
        ab = mul(a, b)
        c = -sum(ab[i][i] for i in range(d)) / k
        out.append(c)
        b = [[ab[i][j] + (c if i == j else 0) for j in range(d)] for i in range(d)]
    return [int(c) for c in reversed(out)]


@pytest.mark.parametrize("kind", ["full", "low rank", "zeros below"])
def test_polynomial(spark, kind):
    rng = np.random.default_rng(5)
    a = rng.integers(-1000, 1000, (7, 3 if kind == "low rank" else 9))
    m = (a @ a.T).astype(object) * 10**9
    if kind == "zeros below":
        m = np.diag([5, 5, 3, 0, 2, 1, 5]).astype(object)
    assert whitening.characteristic_polynomial(spark, m.tolist()) == exact_polynomial(m.tolist())


def test_roots_that_repeat_or_nearly_do():
    def product(roots):
        out = [1]
        for r in roots:
            out = [(out[i - 1] if i else 0) - r * (out[i] if i < len(out) else 0) for i in range(len(out) + 1)]
        return out

    for roots in ([9, 9, 9, 4, 1], [10**30 + 1, 10**30, 5, 0], [7], [0, 0, 0], [12, 3, 3, 3, 3, 2]):
        found = whitening.largest_roots(product(roots), 4)
        want = sorted(roots, reverse=True)[:4]
        assert [round(Fraction(a, 1 << s)) for a, s in found] == want
        assert [whitening.roots_above(product(roots), r - 1) for r in want] == [sum(q > r - 1 for q in roots) for r in want]


def test_close_and_equal_eigenvalues(spark):
    """Axes of equal variance, and two whose variances differ by one part in 10**9."""
    d, rows = 4, []
    for axis, size in enumerate((4, 4, 3, 2)):
        for sign in (1, -1):
            v = [0.0] * d
            v[axis] = sign * float(size)
            rows.append(v)
    got = whitening.report(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")).toPandas()
    assert len(got) == 32 and got.identity_error.max() < 1e-12
    assert np.allclose(sorted(set(got.explained.round(9)), reverse=True), [16 / 45, 9 / 45, 4 / 45])
    m = np.diag([10**18 + 10**9, 10**18, 7, 3]).astype(object)
    turn = np.array([[3, 4, 0, 0], [-4, 3, 0, 0], [0, 0, 5, 0], [0, 0, 0, 5]], object)
    m = turn.T @ m @ turn
    (a, s), _ = whitening.largest_roots(exact_polynomial(m.tolist()), 2)
    with whitening.localcontext(whitening.Context(prec=whitening.DIGITS)):
        (v,) = whitening.null_vectors(m, whitening.Decimal(a) / whitening.Decimal(1 << s), 1)
    assert abs(abs(float(v[0])) - 0.6) < 1e-15 and abs(abs(float(v[1])) - 0.8) < 1e-15


def test_fewer_components_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], schema)
    got = whitening.report(line).toPandas()
    assert set(got.component) == {1} and np.allclose(got.explained, 1)
    for rows in ([], [(1, [1.0, 2.0])] * 5, [(1, None)]):
        assert whitening.report(spark.createDataFrame(rows, schema)).count() == 0


def test_entries_beyond_doubles_of_whole_numbers(spark):
    rows = [(0, [1e15, -3.0]), (1, [-1e15, 5.0]), (2, [1e300, 0.0]), (3, [0.0, -1e300])]
    got = whitening.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert len(got) == 8 and got.whitened.notna().all() and got.deviation.isna().all()
    x = [[int(max(-(2**63), min(2**63 - 1, math.floor(256 * c)))) for c in v] for _, v in rows]
    n, sums, products = whitening.scatter_sums(spark.createDataFrame([(v,) for v in x], "x array<long>"), 2)
    assert (n, list(sums)) == (4, [sum(c) for c in zip(*x)])
    assert [[int(v) for v in r] for r in products] == [[sum(v[i] * v[j] for v in x) for j in range(2)] for i in range(2)]
