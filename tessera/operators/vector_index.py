"""A stored inverted-file index with a two-level quantiser and byte codes, and its sampled recall gate.

Vectors go to cells, whose number grows with the square root of theirs, so that a cell and the list of
cells both stay small. Cells are the means of a k-means whose rounds are Spark jobs over a sample that
grows with the cells: tasks assign vectors and add them up by cell, and only the means come to the
driver. Above the cells stands a second, coarse level, again the square root of them, so that finding
the cells of a vector costs a fourth root's work instead of all.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import retrieval
from tessera.operators.retrieval import matrix, whole_vectors
from tessera.session import materialise, ship_package

#: Sampled vectors for each cell, rounds of k-means, and coarse groups looked at besides those needed.
PER_CELL, ROUNDS, SPARE, SEED = 64, 6, 8, 3


class Centres:
    """Cells in order of their coarse group; starts[g] is the first cell of group g."""

    def __init__(self, cells: np.ndarray, seed: int = SEED):
        n = max(1, math.isqrt(len(cells)))
        coarse = cells[np.random.default_rng(seed).choice(len(cells), n, replace=False)]
        for _ in range(ROUNDS):
            own = np.argmax(cells @ coarse.T, axis=1)
            coarse = np.stack([_unit(cells[own == g].mean(axis=0)) if (own == g).any() else coarse[g] for g in range(n)])
        own = np.argmax(cells @ coarse.T, axis=1)
        self.cells, self.coarse = cells[np.argsort(own, kind="stable")], coarse
        self.starts = np.searchsorted(np.sort(own), np.arange(n + 1))

    def __len__(self) -> int:
        return len(self.cells)

    def nearest(self, m: np.ndarray, probes: int) -> np.ndarray:
        """About the `probes` nearest cells of each row by inner product: the nearest of the groups
        whose coarse centres are nearest, enough groups to hold four times as many cells."""
        probes = min(probes, len(self))
        groups = min(len(self.coarse), SPARE + -(-4 * probes * len(self.coarse) // len(self)))
        sizes = np.diff(self.starts)
        chosen = np.argsort(-(m @ self.coarse.T), axis=1, kind="stable")
        while (sizes[chosen[:, :groups]].sum(axis=1) < probes).any():
            groups = min(len(self.coarse), 2 * groups)
        chosen = chosen[:, :groups]
        best_s, best = np.full((len(m), probes), -np.inf), np.zeros((len(m), probes), np.int32)
        for g in np.unique(chosen):
            a, b = self.starts[g], self.starts[g + 1]
            rows = np.flatnonzero((chosen == g).any(axis=1))
            if a == b:
                continue
            s = np.concatenate([best_s[rows], m[rows] @ self.cells[a:b].T], axis=1)
            names = np.concatenate([best[rows], np.broadcast_to(np.arange(a, b, dtype=np.int32), (len(rows), b - a))], axis=1)
            top = np.argpartition(-s, probes - 1, axis=1)[:, :probes] if s.shape[1] > probes else np.broadcast_to(np.arange(s.shape[1]), s.shape)
            best_s[rows], best[rows] = np.take_along_axis(s, top, 1), np.take_along_axis(names, top, 1)
        return np.take_along_axis(best, np.argsort(-best_s, axis=1, kind="stable"), 1)


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=-1, keepdims=True)
    return m / np.where(n > 0, n, 1)


def trained(vectors: DataFrame, key: str, vector: str, total: int, cells: int, rounds: int = ROUNDS, seed: int = SEED) -> Centres:
    """k-means over PER_CELL vectors a cell, all if there are fewer, chosen by seeded hash of the key.
    A round is one job: assignment and sums by cell in tasks, sums of the tasks merged by cell."""
    few = vectors if total <= PER_CELL * cells else vectors.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 40)) < int((1 << 40) * (PER_CELL * cells / total)))
    sample = materialise(few.select(F.xxhash64(F.col(key), F.lit(seed + 1)).alias("place"), F.col(vector).cast("array<double>").alias("v")), "sample")
    first = sample.orderBy("place", "v").limit(cells).select("v").toArrow()
    centres = Centres(_unit(matrix(first.column(0))), seed)
    schema = "cell int, n long, v array<double>"

    def added(ids: np.ndarray, counts: np.ndarray, sums: np.ndarray):
        return pa.RecordBatch.from_pydict({"cell": pa.array(ids, pa.int32()), "n": pa.array(counts, pa.int64()), "v": pa.array(list(sums), pa.list_(pa.float64()))})

    for _ in range(rounds):
        shared = vectors.sparkSession.sparkContext.broadcast(centres)

        def assign(batches, shared=shared):
            c = shared.value
            counts, sums = np.zeros(len(c), np.int64), np.zeros(c.cells.shape)
            for b in batches:
                m = matrix(b.column(0))
                own = c.nearest(m, 1)[:, 0]
                np.add.at(sums, own, m)
                counts += np.bincount(own, minlength=len(c))
            met = np.flatnonzero(counts)
            for i in range(0, len(met), 4096):
                yield added(met[i : i + 4096], counts[met[i : i + 4096]], sums[met[i : i + 4096]])

        def merge(batches):
            held = {}
            for b in batches:
                for cell, n, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), matrix(b.column(2)), strict=True):
                    n0, v0 = held.get(cell, (0, 0.0))
                    held[cell] = n0 + n, v0 + v
            names = sorted(held)
            for i in range(0, len(names), 4096):
                part = names[i : i + 4096]
                yield added(part, [held[x][0] for x in part], [held[x][1] for x in part])

        means = sample.select("v").mapInArrow(assign, schema).repartition("cell").mapInArrow(merge, schema).toArrow()
        new = centres.cells.copy()
        if means.num_rows:
            new[means.column("cell").to_numpy()] = _unit(matrix(means.column("v")) / means.column("n").to_numpy()[:, None])
        centres = Centres(new, seed)
    return centres


class Index:
    """centres, sizes of the cells, per-dimension low and step of the codes, and the table (key, cell, code, vector)."""

    def __init__(self, table: DataFrame, centres: Centres, sizes: np.ndarray, low: np.ndarray, step: np.ndarray, key: str):
        self.table, self.centres, self.sizes, self.low, self.step, self.key = table, centres, sizes, low, step, key


def cells_of(n: int) -> int:
    """How many cells n vectors get: four times their square root."""
    return max(16, 4 * math.isqrt(n))


def build(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cells: int | None = None) -> Index:
    """Codes are bytes over the range of each dimension; they only choose candidates, which the vectors beside
    them decide. Rows of a cell lie together in each file. Rows without a key, null vectors, such
    with null or non-finite components and such of a length that is not the commonest are not indexed."""
    spark = vectors.sparkSession
    ship_package(spark)
    lengths = vectors.where(F.size(vector) > 0).groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = lengths.d if lengths else 1
    whole = vectors.where(whole_vectors(vector, d) & F.col(key).isNotNull()).select(key, F.col(vector).cast("array<double>").alias(vector))
    total = whole.count()
    centres = trained(whole, key, vector, total, min(total, cells or cells_of(total))) if total else Centres(np.zeros((1, d)))
    ranges = whole.select(F.posexplode(vector).alias("i", "x")).groupBy("i").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("i").collect()  # a row a dimension
    low = np.array([float(r.low) for r in ranges]) if total else np.zeros(d)
    step = np.maximum((np.array([float(r.high) for r in ranges]) - low) / 255, 1e-12) if total else np.ones(d)
    shared = spark.sparkContext.broadcast(centres)

    def run(batches):
        c = shared.value
        for b in batches:
            m = matrix(b.column(1))
            cell = c.nearest(m, 1)[:, 0] if len(m) else np.zeros(0, np.int32)
            code = np.clip(np.rint((m - low) / step), 0, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cell), pa.array([r.tobytes() for r in code], pa.binary()), b.column(1)], names=[key, "cell", "code", "vector"])

    kinds = f"{key} {vectors.schema[key].dataType.simpleString()}, cell int, code binary, vector array<double>"
    table = materialise(whole.mapInArrow(run, kinds).sortWithinPartitions("cell"), "index")
    sizes = np.zeros(len(centres), np.int64)
    for cell, n in table.groupBy("cell").count().collect():  # a row a cell
        sizes[cell] = n
    return Index(table, centres, sizes, low, step, key)


#: Queries that go to every task at once, their bits for the cells, and pairs of one tile.
MOST, BITS, PAIRS = 20_000, 256_000_000, 1_000_000


def candidates(index: Index, queries: DataFrame, k: int, probes: int, query_key: str = "query_id", vector: str = "embedding", least: int = 0, turn: int = 0) -> DataFrame:
    """(query_key, key, score): the k best of each query in its cells, by exact inner product, from every task.

    A query probes its `probes` nearest cells, twice as many as long as they hold fewer than `least` vectors
    and there are more. Queries, at most MOST, go to every task with a bit for each query and cell; more are
    taken in turns. A task reads its part of the index and scores each cell for the queries that probe it: a
    vector whose code, with the most that it can be off, does not reach a query's k-th best so far is passed
    over, the others are scored exactly. So no pair is a row of a shuffle but the k best of a task, and every
    vector of a probed cell is judged. A task holds the queries, k results of each and one tile.
    """
    spark, key, low, step, centres, sizes = queries.sparkSession, index.key, index.low, index.step, index.centres, index.sizes
    most = max(1, min(MOST, BITS // len(centres)))
    asked = queries.where(whole_vectors(vector, len(low)) & F.col(query_key).isNotNull()).select(query_key, F.col(vector).cast("array<double>").alias(vector))
    total = asked.count()
    if total > most:
        n = -(-total // most) * 2
        own = F.pmod(F.xxhash64(query_key, vector, F.lit(turn)), F.lit(n))
        return reduce(DataFrame.unionByName, [candidates(index, asked.where(own == i), k, probes, query_key, vector, least, turn + 1) for i in range(n)])
    shared = spark.sparkContext.broadcast(centres)

    def probe(batches):
        c = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                rows = b.slice(at, 1024)
                m = matrix(rows.column(1))
                met, short, p = np.zeros((len(m), len(c)), bool), np.arange(len(m)), probes
                while len(short):
                    near = c.nearest(m[short], p)
                    met[short[:, None], near] = True
                    short, p = short[sizes[near].sum(axis=1) < least] if p < len(c) else short[:0], 2 * p
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([r.tobytes() for r in np.packbits(met, axis=1)], pa.binary())], names=[query_key, vector, "cells"])

    kind = queries.schema[query_key].dataType.simpleString()
    got = asked.mapInArrow(probe, f"{query_key} {kind}, {vector} array<double>, cells binary").toArrow()
    names = got.column(0).combine_chunks()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    m = matrix(got.column(1)) if len(names) else np.zeros((0, len(low)))
    bits = np.frombuffer(b"".join(got.column(2).to_pylist()), np.uint8).reshape(len(names), -1)
    bits = np.packbits(np.unpackbits(bits, axis=1, count=len(centres)), axis=0) if len(names) else np.zeros((0, len(centres)), np.uint8)
    # half a step of a code a dimension, what rounding takes, and half of the last digit of a score
    off = np.abs(m) @ (step / 2 + 1e-9 * (np.abs(low) + 255 * step)) + 1e-6
    held = spark.sparkContext.broadcast((names, m, off, np.ascontiguousarray(bits.T)))

    def run(batches):
        names_, q, off_, bits_ = held.value
        n, floor, waiting, size, kind_ = len(names_), np.full(len(names_), -np.inf), [], 0, None

        def best(waiting):
            """The k best of each query; ties go to the smaller key."""
            own, s, keys = (np.concatenate(x) for x in zip(*waiting, strict=True))
            order = np.lexsort((keys, -s, own))
            own, s, keys = own[order], s[order], keys[order]
            begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            rank = np.arange(len(own)) - np.repeat(begins, np.diff(np.r_[begins, len(own)]))
            floor[own[rank == k - 1]] = s[rank == k - 1]
            return [(own[rank < k], s[rank < k], keys[rank < k])]

        for b in batches:
            if not b.num_rows or not n:
                continue
            kind_ = b.schema.field(0).type
            cell = b.column(1).to_numpy(zero_copy_only=False)
            order = np.argsort(cell, kind="stable")
            cell, keys, v = cell[order], np.array(b.column(0).to_pylist())[order], matrix(b.column(3))[order]
            code = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(len(cell), -1)[order]
            begins = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            for a, z in zip(begins, [*begins[1:], len(cell)], strict=True):
                own = np.flatnonzero(np.unpackbits(bits_[cell[a]], count=n))
                for i in range(0, len(own), PAIRS):
                    ask = own[i : i + PAIRS]
                    qs, width = q[ask], max(1, PAIRS // len(ask))
                    for x in range(a, z, width):
                        y = min(x + width, z)
                        near = qs @ (code[x:y] * step + low).T + off_[ask, None] >= floor[ask, None]
                        r, c = np.nonzero(near)
                        few = len(r) * q.shape[1] <= near.size
                        s = np.round(np.einsum("ij,ij->i", qs[r], v[x + c]) if few else (qs @ v[x:y].T)[r, c], 6)
                        good = s >= floor[ask[r]]
                        if good.any():
                            waiting.append((ask[r[good]], s[good], keys[x + c[good]]))
                            size += int(good.sum())
                        if size > max(retrieval.WAITING, 2 * k * n):
                            waiting = best(waiting)
                            size = len(waiting[0][0])
        if waiting:
            ((own, s, keys),) = best(waiting)
            for i in range(0, len(own), 65_536):
                part = slice(i, i + 65_536)
                yield pa.RecordBatch.from_arrays([names_.take(pa.array(own[part])), pa.array(keys[part].tolist(), kind_), pa.array(s[part])], names=[query_key, key, "score"])

    return index.table.mapInArrow(run, f"{query_key} {kind}, {key} {index.table.schema[key].dataType.simpleString()}, score double")


def search(index: Index, queries: DataFrame, vectors: DataFrame, k: int, probes: int, query_key: str = "query_id", vector: str = "embedding") -> DataFrame:
    """(query_key, key, score, rank): the k best of each query in the cells that it probes, by exact inner
    product; probes are doubled for the queries whose cells hold fewer than k, and for those alone. `vectors`
    is what was indexed: the index holds them beside their codes, so they are not joined."""
    return retrieval.ranked(candidates(index, queries, k, probes, query_key, vector, k), query_key, index.key, k)


def gated_search(index: Index, queries: DataFrame, vectors: DataFrame, k: int, probes: int = 4, least: float = 0.95, sample: int = 8, query_key: str = "query_id", vector: str = "embedding") -> tuple[DataFrame, float, int]:
    """(hits, recall, probes): probes are doubled until the mean recall of `sample` queries, the first by
    hash, reaches `least` against exact search; if all cells do not reach it, an error."""
    few = materialise(queries.orderBy(F.xxhash64(query_key), query_key).limit(sample), "gate")
    exact = materialise(retrieval.exact_topk(few, vectors, k, query_key, index.key, vector), "gate")
    while True:
        recall = retrieval.recall_against(exact, search(index, few, vectors, k, probes, query_key, vector), query_key, index.key).first()["recall"]
        recall = 1.0 if recall is None else recall
        if recall >= least:
            return search(index, queries, vectors, k, probes, query_key, vector), recall, probes
        if probes >= len(index.centres):
            raise ValueError(f"recall {recall:.3f} stays below {least}")
        probes *= 2
