import math
import random
from fractions import Fraction

import numpy as np
import pytest

from factloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, part string"


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, d)) @ np.diag(np.linspace(0.2, 3, d)) @ rng.normal(size=(d, d))
    return [[float(np.float32(c)) for c in row] for row in a]


def brute(vs):
    """(x of each row, n, S, covariance as fractions)."""
    xs = [tuple(math.floor(64 * c) + 1000000 for c in v) for v in vs]
    fit = sorted(set(xs))
    n, d = len(fit), len(fit[0])
    S = [sum(x[i] for x in fit) for i in range(d)]
    c = [[Fraction(x[i]) - Fraction(S[i], n) for i in range(d)] for x in fit]
    return xs, n, S, [[sum(r[i] * r[j] for r in c) / n for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d", [5, 20])
def test_whitened_rows_by_fractions(spark, d):
    vs = vectors(60, d, d)
    bad = [None, [1.0] * (d - 1) + [None], [float("nan")] + [0.0] * (d - 1), [float("inf")] * d, [-float("inf")] * d, [], [1e38] * d]
    rows = [(i, v, 0, "a", "b") for i, v in enumerate(vs + vs[:9])] + [(1000 + i, v, 0, "a", "b") for i, v in enumerate(bad)] + [(None, vs[0], None, None, None)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    xs, n, S, V = brute(vs)
    k = min(16, d)
    assert len(got) == (len(vs) + 10) * k and {r.n for r in got} == {n}
    values, vecs = np.linalg.eigh(np.array([[float(v) for v in row] for row in V]))
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    trace = float(sum(V[i][i] for i in range(d)))
    sign = {}
    for r in got:
        x = xs[r.vec_id % len(vs)] if r.vec_id is not None else xs[0]
        assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, S))
        own = sum(float(Fraction(c) - Fraction(s, n)) * vecs[i, r.component - 1] for i, (c, s) in enumerate(zip(x, S))) / math.sqrt(values[r.component - 1])
        if abs(own) > 0.1:
            sign.setdefault(r.component, math.copysign(1, own * r.whitened))
        assert abs(own - sign.get(r.component, 1) * r.whitened) < 1e-8 or abs(own) <= 0.1
        assert abs(r.explained / (values[r.component - 1] / trace) - 1) < 1e-9
        assert 0 <= r.identity_error < 1e-9


def test_error_free_sums_and_products():
    rng = random.Random(1)
    for _ in range(300):
        a, b = (rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12) for _ in range(2))
        for f, exact in ((whitening.two_sum, Fraction(a) + Fraction(b)), (whitening.two_product, Fraction(a) * Fraction(b))):
            high, low = f(np.float64(a), np.float64(b))
            assert Fraction(float(high)) + Fraction(float(low)) == exact
    xs = [rng.uniform(-1, 1) * 10 ** rng.randint(0, 15) for _ in range(1001)]
    xs += [-x for x in xs] + [1e-9]
    high, low = whitening.total((np.array(xs)[:, None], np.zeros((len(xs), 1))))
    assert abs(float(high[0] + low[0]) - 1e-9) < 1e-13
    q = whitening.divided((np.array([1.0]), np.array([0.0])), 3)
    assert abs(Fraction(float(q[0][0])) + Fraction(float(q[1][0])) - Fraction(1, 3)) < Fraction(1, 2**100)


def test_covariance_survives_a_large_mean(spark):
    """One pass of sums of squares would lose these digits: means of 10^6 * 64 * 4096, differences of a few units."""
    base = 2.0**32
    vs = [[base + i / 64 * j for j in (1, 2)] for i in (0, 1, 5)] + [[base, base + 1 / 64]]
    got = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "vec_id long, embedding array<double>")).collect()
    xs, n, S, V = brute(vs)
    values = np.sort(np.linalg.eigvalsh(np.array([[float(v) for v in r] for r in V])))[::-1]
    assert {(r.component, round(r.explained * float(V[0][0] + V[1][1]), 9)) for r in got} == {(i + 1, round(v, 9)) for i, v in enumerate(values)}
    assert {r.deviation for r in got} == {sum((n * c - s) ** 2 for c, s in zip(x, S)) for x in xs}


def test_sums_beyond_a_long(spark):
    vs = [[2.0**47, 0.0], [-(2.0**47), 1.0], [0.0, 5.0]]
    got = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "vec_id long, embedding array<double>")).collect()
    xs, n, S, _ = brute(vs)
    exact = {i: sum((n * c - s) ** 2 for c, s in zip(x, S)) for i, x in enumerate(xs)}
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 2**63 else None) for r in got) and any(r.deviation is None for r in got)


def test_nothing_to_whiten(spark):
    make = lambda rows: spark.createDataFrame([(i, v, 0, "", "") for i, v in enumerate(rows)], SCHEMA)
    for rows in ([], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 4):
        out = whitening.whiten(make(rows))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = whitening.whiten(make([[1.0, 2.0], [3.0, 2.0], [9.0, 2.0], [1.0], [4.0]])).collect()  # one direction only; other lengths are not used
    assert {(r.vec_id, r.component) for r in flat} == {(0, 1), (1, 1), (2, 1)} and all(abs(r.explained - 1) < 1e-12 for r in flat)
