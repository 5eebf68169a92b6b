"""Whitening against exact arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import registry, whitening


def plain(rows, most=16):
    """(n, sums, deviation by key order, eigenvalues, eigenvectors) from whole numbers, exactly until the eigen-solve."""
    xs = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows]
    distinct = sorted(set(map(tuple, xs)))
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[i] for x in distinct) for i in range(d)]
    apart = np.array([[n * a - s for a, s in zip(x, sums, strict=True)] for x in distinct], dtype=object)
    v = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in apart.T @ apart])
    value, vector = np.linalg.eigh(v)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for x in xs]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)] for x in xs])
    return n, deviation, centred, value[::-1][:most], vector[:, ::-1][:, :most], np.trace(v)


def compare(got, rows, keys):
    n, deviation, centred, value, vector, trace = plain(rows)
    k = len(value)
    table = {(r.vec_id, r.component): r for r in got}
    assert len(table) == len(got) == len(rows) * k
    sign = None
    for i, key in enumerate(keys):
        z = centred[i] @ vector / np.sqrt(value)
        mine = np.array([table[key, c + 1].whitened for c in range(k)])
        sign = np.where(z * mine < 0, -1, 1) if sign is None else np.where(np.abs(z) > 1e-6, sign, sign)
        assert np.allclose(z * sign, mine, rtol=0, atol=1e-7)
        for c in range(k):
            r = table[key, c + 1]
            assert (r.n, r.deviation) == (n, deviation[i]) and abs(r.explained - value[c] / trace) < 1e-9 and r.identity_error < 1e-9


def test_query_equals_exact_arithmetic(spark):
    base = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{base}/embeddings.parquet").collect()
    compare(registry.queries()["op12_whitening"](spark, base).collect(), [r.embedding for r in rows], [r.vec_id for r in rows])


@pytest.mark.parametrize("parts", [1, 13])
def test_moments_hold_over_thirty_digits(spark, parts):
    """A spread of one part in a billion of the offset, rows of very unlike size."""
    rng = np.random.default_rng(parts)
    x = rng.integers(-3, 4, (5000, 5)) + np.array([10**13, -(10**12), 7, 0, 2**40])
    x[::7, 1] += rng.integers(0, 10**9, len(x[::7]))
    fit = spark.createDataFrame([(row,) for row in x.tolist()], "x array<long>").repartition(parts)
    n, sums = whitening.totals(fit, 5)
    assert n == len(x) and sums == [sum(map(int, x[:, i])) for i in range(5)]
    centre = whitening.mean(n, sums)
    high, low = whitening.moments(fit, 5, lambda b: whitening.centred(b, centre))
    apart = n * x.astype(object) - np.array(sums, dtype=object)
    exact = apart.T @ apart
    for i in range(5):
        for j in range(5):
            want, scale = Fraction(int(exact[i, j]), n * n), math.sqrt(int(exact[i, i]) * int(exact[j, j])) / n / n
            assert abs(Fraction(high[i, j]) + Fraction(low[i, j]) - want) <= Fraction(scale) * Fraction(1, 10**24)


def test_components_of_close_eigenvalues():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((20, 20)))
    value = np.array([1 + 1e-7 * i for i in range(10)] + [1e-6 * (i + 1) for i in range(10)])
    a = (q * value) @ q.T
    got, vector = whitening.components(a, np.zeros_like(a))
    assert np.allclose(got, sorted(value)[::-1], rtol=1e-12, atol=1e-15)
    assert np.abs(vector.T @ vector - np.eye(20)).max() < 1e-14
    assert np.abs(a @ vector - vector * got).max() < 1e-14


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [list(map(float, v)) for v in rng.standard_normal((40, 3))]
    keys = list(range(40)) + [40, None, 41]
    rows = [*good, good[0], good[1], [-0.0, 1e4, -3.5]]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]), (54, [1.0, float("-inf"), 2.0]), (55, [1.0, 2.0]), (56, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame([*zip(keys, rows, strict=True), *bad], "vec_id long, embedding array<double>").selectExpr("*", "1 as x", "2 as key", "3 as component", "4 as n", "5 as i")
    got = whitening.whiten(df).collect()
    assert sum(r.vec_id is None for r in got) == 3
    compare(got, rows, keys)


def test_without_variance_or_rows(spark):
    schema = "vec_id string, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    same = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0])], schema)
    assert whitening.whiten(same).collect() == []
    line = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 3.0]), ("c", [1.0, 3.0])], schema)
    got = whitening.whiten(line).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation, abs(round(r.whitened, 9)), r.explained) for r in got} == {(k, 1, 2, 4096, 1.0, 1.0) for k in "abc"}
