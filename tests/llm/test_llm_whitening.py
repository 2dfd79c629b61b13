import math
import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from talentmatch.llm import whitening as WH

ROWS = "vec_id long, embedding array<float>, label int"


def exact_polynomial(a):
    """det(t - a) by the recurrence on traces, in fractions; t^0 first."""
    d = len(a)
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][x] * m[x][j] for x in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        am = [[sum(a[i][x] * m[x][j] for x in range(d)) for j in range(d)] for i in range(d)]
        c.append(-Fraction(sum(am[i][i] for i in range(d)), k))
    return [int(x) for x in reversed(c)]


def gram(seed, d, n, high=50):
    rng = random.Random(seed)
    v = [[rng.randint(-high, high) for _ in range(d)] for _ in range(n)]
    return [[sum(r[i] * r[j] for r in v) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("a", [gram(1, 5, 9), gram(2, 7, 3), gram(3, 1, 2), [[0, 0], [0, 0]], [[4, 0, 0], [0, 4, 0], [0, 0, 1]], gram(4, 6, 9, 10 ** 12)])
def test_characteristic_polynomial_is_exact(spark, a):
    assert WH.characteristic_polynomial(spark, a) == exact_polynomial(a)


def test_roots_are_isolated_with_multiplicity():
    roots = [12, 7, 7, 7, 3, 0, 0]
    c = [1]
    for r in roots:
        c = [(c[i - 1] if i else 0) - r * (c[i] if i < len(c) else 0) for i in range(len(c) + 1)]
    assert [WH.roots_above(c, p) for p in (12, 11, 7, 6, 2, 0)] == [0, 1, 1, 4, 5, 5]
    assert [WH.kth_root(c, k, 36) for k in range(1, 8)] == [r << WH.FRACTION for r in roots]
    # t^2 - 4 t + 2: 2 + sqrt 2
    assert WH.kth_root([2, -4, 1], 1, 4) == (2 << 64) + math.isqrt(2 << 128) + 1


def test_null_spaces_of_equal_and_close_roots(spark):
    a = [[4, 0, 0, 0], [0, 4, 0, 0], [0, 0, 9, 0], [0, 0, 0, 0]]
    roots = [r << WH.FRACTION for r in (9, 4, 4, 0)]
    v = np.array(WH.components_of(spark, a, roots))
    assert np.allclose(v @ v.T, np.eye(4), atol=1e-15)
    assert np.allclose(v @ np.array(a) @ v.T, np.diag([9, 4, 4, 0]), atol=1e-14)
    # gaps of one in 10^15: no double arithmetic tells them apart
    big = 10 ** 15
    a = [[big, 1, 0], [1, big, 0], [0, 0, big - 3]]
    c = WH.characteristic_polynomial(spark, a)
    roots = WH.largest_roots(spark, c, 3, 3 * big)
    assert [r / 2 ** 64 - big for r in roots] == pytest.approx([1, -1, -3], abs=0.2)
    v = np.array(WH.components_of(spark, a, roots))
    assert np.allclose(np.abs(v), [[0.5 ** 0.5, 0.5 ** 0.5, 0], [0.5 ** 0.5, 0.5 ** 0.5, 0], [0, 0, 1]], atol=1e-15)


def vectors(seed, n=120, d=10):
    rng = np.random.default_rng(seed)
    return [[float(np.float32(c)) for c in v] for v in rng.normal(size=(n, d)) * np.linspace(0.2, 1, d) + 0.3]


def brute(rows, components=8):
    kept = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in kept]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    y = np.array([[float(Fraction(n * r[j] - s[j], n)) for j in range(d)] for r in x])
    e, w = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-e)[:components]
    return {(i, k + 1): (n, sum((n * r[j] - s[j]) ** 2 for j in range(d)), float(y[at] @ w[:, o] / math.sqrt(e[o])), e[o] / e.sum())
            for at, ((i, _), r) in enumerate(zip(kept, x)) for k, o in enumerate(order)}


def result(df):
    return {(r.id, r.component): (r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in df.collect()}


def test_whitening_matches_brute_force(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(1))]
    rows += [(500, None, 0), (501, [None] * 10, 0), (502, [float("nan")] * 10, 0), (503, [float("inf")] + [0.0] * 9, 0), (504, rows[3][1], 0)]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    for c in ("id", "v", "n", "component", "whitened"):
        df = df.withColumn(c, F.lit("x"))
    got, want = result(WH.whiten(df)), brute(rows)
    assert got.keys() == want.keys()
    for k in range(1, 9):
        sign = np.sign(got[0, k][2] * want[0, k][2])
        for key in (key for key in got if key[1] == k):
            assert got[key][:2] == want[key][:2]
            assert got[key][2] * sign == pytest.approx(want[key][2], abs=1e-9)
            assert got[key][3] == pytest.approx(want[key][3], rel=1e-10)
            assert got[key][4] < 1e-12
    assert len({v[4] for v in got.values()}) == 1


def test_equal_variances_and_components_without_any(spark):
    # four corners: two equal variances, and two dimensions that never change
    rows = [(i, [a, b, 0.5, -0.5], 0) for i, (a, b) in enumerate([(1.0, 1.0), (1.0, -1.0), (-1.0, 1.0), (-1.0, -1.0)])]
    got = {(r.id, r.component): r for r in WH.whiten(spark.createDataFrame(rows, ROWS)).collect()}
    assert len(got) == 16
    assert all((r.whitened is None) == (k > 2) and r.identity_error < 1e-12 for (_, k), r in got.items())
    assert [round(got[0, k].explained, 12) for k in (1, 2, 3, 4)] == [0.5, 0.5, 0, 0]


def test_empty_single_short_and_huge(spark):
    make = lambda rows: spark.createDataFrame(rows, ROWS)
    assert WH.whiten(make([])).count() == 0
    assert WH.whiten(make([(1, None, 0), (2, [], 0)])).count() == 0
    alone = WH.whiten(make([(1, [0.5, 0.25], 0)])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened) for r in alone] == [(1, 1, 0, None), (2, 1, 0, None)]
    # a short vector counts as if it held zeros; null ids stay
    got = WH.whiten(make([(None, [1.0, 1.0], 0), (2, [1.0], 0), (3, [2.0, -1.0, ], 0)])).collect()
    assert len(got) == 6 and sum(r.id is None for r in got) == 2
    huge = make([(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [1e15, 4.0], 0)])
    got = WH.whiten(huge).collect()
    assert len(got) == 6 and all(math.isfinite(r.whitened) and r.identity_error < 1e-6 for r in got)


def test_integer_paths_agree():
    x = np.array([[3, -5], [2 ** 40, 7], [-2 ** 40, 1]], dtype=np.int64)
    sums = [int(v) for v in x.sum(axis=0)]
    assert WH.deviations(x, 3, sums) == [sum((3 * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
    small = x[:1]
    assert WH.deviations(small, 1, [3, -4]) == [1]
    assert WH._halves(-5) == (Decimal(-1), Decimal(2 ** 64 - 5))
