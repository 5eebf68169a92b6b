"""Embedding whitening from a compensated covariance.

An embedding is brought to whole numbers, x = floor(64 c) + 1000000, so equal vectors are equal
exactly; each distinct x counts once. Their sums are exact. The mean is kept in double-double, a pair
of doubles (high, low) whose sum has about 106 bits, and vectors are centred by it before anything is
multiplied: the offset of a million would otherwise eat the digits of the covariance.

Outer products are summed in double-double by error-free transformations. Rows are cut into slices of
so few bits that every product of two slices, summed over a block of rows, is a double without
rounding (Ozaki, Ogita, Oishi and Rump, Numerical Algorithms 59, 2012); each such exact matrix is
added to the running (high, low) pair by Knuth's two-sum, which keeps the error of the addition. A
task gives its pair, row by row; pairs merge as streams, one key for each row of the matrix, so what
a task holds is d x d whatever the number of tasks, and the driver gets d rows.

The eigen-solve reduces the matrix to tridiagonal form and solves that by divide and conquer (LAPACK's
syevd, which numpy calls). One step of Ogita and Aishima's refinement (Japan J. Indust. Appl. Math.
35, 2018) against the double-double matrix then mends what rounding to double had cost.

Defined results: rows whose vector is null or empty, holds null or non-finite entries, or entries
beyond 2**46 are left out; so are rows whose length is not the commonest one of the distinct vectors
(the smaller on a tie). Repeated rows each get their own result; a missing key stays null.
Directions whose variance is below rounding, d x 2**-52 of the greatest, are no components, so one
distinct vector gives no rows. `deviation` is
null where it exceeds a long. Extra columns are not read.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialise, ship_package

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
ROWS = 1024  # rows whose sliced products are summed without rounding
_SLICE = (53 + ROWS.bit_length()) // 2 + 1


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum as a double and its rounding error: together exactly a + b."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def add(high: np.ndarray, low: np.ndarray, more: np.ndarray, less: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(high, low) + (more, less) in double-double."""
    s, e = two_sum(high, more)
    return two_sum(s, e + low + less)


def _slice(a: np.ndarray) -> np.ndarray:
    """The leading bits of each entry, as many as keep sums of products over ROWS rows exact."""
    top = np.abs(a).max(axis=0)
    sigma = np.where(top > 0, 2.0 ** (np.ceil(np.log2(np.where(top > 0, top, 1.0))) + _SLICE), 0.0)
    return (a + sigma) - sigma


def outer(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of outer products of the rows high + low, at most ROWS of them, in double-double."""
    first = _slice(high)
    second = _slice(high - first)
    rest = (high - first - second) + low
    cross, mixed = first.T @ second, (first + second).T @ rest
    h, e = first.T @ first, np.zeros((high.shape[1], high.shape[1]))
    for exact in (cross, cross.T, second.T @ second):
        h, e = add(h, e, exact)
    return add(h, e, 0.0 * h, mixed + mixed.T + rest.T @ rest)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """key, x: the rows whose vector can be brought to whole numbers."""
    rows = vectors.select(F.col(key).alias("key"), F.col(embedding).cast("array<double>").alias("e"))
    fine = F.forall("e", lambda c: F.coalesce(F.abs(c) < float(2**46), F.lit(False)))
    rows = rows.where(F.col("e").isNotNull() & (F.size("e") > 0) & fine)
    return rows.select("key", F.transform("e", lambda c: F.floor(c * SCALE) + F.lit(OFFSET).cast("long")).alias("x"))


def totals(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """(number of vectors, exact sum of each dimension)."""

    def run(batches):
        n, sums = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column("x"))
            n += len(x)
            parts = zip((x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist(), strict=True)
            sums = [s + (a << 32) + b for s, (a, b) in zip(sums, parts, strict=True)]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()), "s": pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))})

    rows = fit.select("x").mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    at = {r.i: r for r in rows}
    return (at[0].n if at else 0), [int(at[i].s) if at else 0 for i in range(d)]


def mean(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """S / n in double-double."""
    exact = [Fraction(s, n) for s in sums]
    high = [float(f) for f in exact]
    return np.array(high), np.array([float(f - Fraction(h)) for f, h in zip(exact, high, strict=True)])


def centred(x: np.ndarray, centre: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    s, e = two_sum(x.astype(np.float64), -centre[0])
    return two_sum(s, e - centre[1])


def moments(fit: DataFrame, d: int, rows) -> tuple[np.ndarray, np.ndarray]:
    """The sum of outer products of all rows in double-double; rows(x) gives (high, low) of a block."""

    def partial(batches):
        high, low = np.zeros((d, d)), np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column("x"))
            for i in range(0, len(x), ROWS):
                high, low = add(high, low, *outer(*rows(x[i : i + ROWS])))
        yield packed(range(d), high, low)

    def packed(names, high, low):
        return pa.RecordBatch.from_pydict({"i": pa.array(names, pa.int32()), "high": pa.array(list(high), pa.list_(pa.float64())), "low": pa.array(list(low), pa.list_(pa.float64()))})

    def merge(batches):
        held = {}
        for batch in batches:
            high, low = _matrix(batch.column("high")), _matrix(batch.column("low"))
            for i, h, e in zip(batch.column("i").to_pylist(), high, low, strict=True):
                held[i] = add(*held[i], h, e) if i in held else (h, e)
        if held:
            yield packed(sorted(held), [held[i][0] for i in sorted(held)], [held[i][1] for i in sorted(held)])

    schema = "i int, high array<double>, low array<double>"
    merged = {r.i: r for r in fit.select("x").mapInArrow(partial, schema).repartition("i").mapInArrow(merge, schema).collect()}
    return np.array([merged[i].high for i in range(d)]), np.array([merged[i].low for i in range(d)])


def components(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of the symmetric matrix high + low. The
    entry of greatest size of each vector is positive."""
    exact = high.astype(np.longdouble) + low.astype(np.longdouble)
    exact = (exact + exact.T) / 2
    size = float(np.abs(high).max()) or 1.0
    _, v = np.linalg.eigh((exact / size).astype(np.float64))
    v, scaled = v.astype(np.longdouble), exact / size
    off = np.eye(len(v)) - v.T @ v
    turned = v.T @ scaled @ v
    value = np.diag(turned) / (1 - np.diag(off))
    near = 2 * (np.linalg.norm((turned - np.diag(value)).astype(float)) + np.linalg.norm(scaled.astype(float)) * np.linalg.norm(off.astype(float)))
    gap = value[None, :] - value[:, None]
    far = np.abs(gap) > near
    v = v + v @ np.where(far, (turned + value[None, :] * off) / np.where(far, gap, 1), off / 2)
    for _ in range(2):  # unit and orthogonal again, to the last digit
        v = v @ (3 * np.eye(len(v)) - v.T @ v) / 2
    value = ((v * (scaled @ v)).sum(axis=0) * size).astype(np.float64)
    order = np.argsort(-value, kind="stable")
    v = v[:, order].astype(np.float64)
    return value[order], v * np.where(np.take_along_axis(v, np.abs(v).argmax(axis=0)[None], 0)[0] < 0, -1.0, 1.0)


def whiten(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: key, component, n, deviation, whitened, explained,
    identity_error.

    The distinct vectors are written once to the shared folder and read by three passes (sums,
    covariance, covariance of the whitened). Copies combine before the shuffle.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = usable(vectors, key, embedding)
    schema = f"key {rows.schema['key'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    distinct = materialise(rows.select("x").distinct(), "whitening")
    lengths = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    named = lambda df: df.withColumnRenamed("key", key)
    if lengths is None:
        return named(spark.createDataFrame([], schema))
    d = lengths.d
    fit = distinct.where(F.size("x") == d)
    n, sums = totals(fit, d)
    centre = mean(n, sums)
    high, low = moments(fit, d, lambda x: centred(x, centre))
    value, vector = components(high, low)
    kept = int((value > d * np.finfo(float).eps * value[0]).sum()) if value[0] > 0 else 0
    k = min(kept, most)
    if not k:
        return named(spark.createDataFrame([], schema))
    explained = (value / np.trace(high + low))[:k]
    turn = vector[:, :k] / np.sqrt(value[:k] / n)

    def project(x):
        top, rest = centred(x, centre)
        return top @ turn + rest @ turn

    def with_one(x):  # the constant's products are the sums, so the second covariance is centred too
        z = np.hstack([project(x), np.ones((len(x), 1))])
        return z, np.zeros_like(z)

    again = sum(moments(fit, k + 1, with_one)) / n
    covariance = again[:k, :k] - np.outer(again[k, :k], again[k, :k])
    error = float(np.abs(covariance - np.eye(k)).max())
    total = np.array(sums, dtype=object)

    def deviations(x):
        apart = (x.astype(np.float64) * n - total.astype(np.float64)) ** 2
        if apart.sum(axis=1).max(initial=0) < 2.0**62 and np.abs(x).max(initial=0) * float(n) < 2.0**62:
            return (((n * x) - total.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum(v * v for v in row) for row in (n * x.astype(object) - total).tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                x = _matrix(part.column("x"))
                m = len(x)
                again = np.repeat(np.arange(m), k)
                columns = {
                    "key": part.column("key").take(pa.array(again)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    "n": pa.array(np.full(m * k, n)),
                    "deviation": pa.array(deviations(x), pa.int64()).take(pa.array(again)),
                    "whitened": pa.array(project(x).ravel()),
                    "explained": pa.array(np.tile(explained, m)),
                    "identity_error": pa.array(np.full(m * k, error)),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return named(rows.where(F.size("x") == d).mapInArrow(run, schema))
