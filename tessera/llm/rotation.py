"""Embedding near-dedup by randomised-rotation binary codes with stored correction factors.

A unit vector o is rotated by one random orthogonal matrix; its code is the signs, as the unit
vector c, and the correction factor is a = <o, c>. Both are computed once for each distinct vector
and stored beside it, the signs packed to bits. For another unit vector q with b = <q, c>, b / a
estimates <o, q> without bias over rotations. The error lies across c, so with certainty
    |<o, q> - a b| <= sqrt(1 - a^2) sqrt(1 - b^2).
A pair whose lowest value reaches the threshold is a link and one whose highest stays below it is
none, by the code alone; what lies between, and that alone, is computed exactly in double precision.
The bounds hold always, so no link is lost or invented, whatever the rotation.

Only equal labels are compared. Equal vectors of a label are one representative with a count. A
label's representatives are dealt into blocks; each pair of blocks is one group of work, so a label
with a third of all rows is many groups, none larger than two blocks. A group emits for each vector
the number of its links and true links that span the group's components, never all pairs.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from tessera.llm.simhash import Forest
from tessera.operators.components import connected_components
from tessera.session import materialise, ship_package

THRESHOLD, BLOCK, SEED = 0.93, 8192, 7
#: What rounding may add to a bound.
SLACK = 1e-5


@functools.lru_cache(4)
def rotation(dimension: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(signs packed to bits, correction factors) of the rows of `unit`."""
    turned = unit @ rotation(unit.shape[1], seed)
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def bounds(query: np.ndarray, bits: np.ndarray, correction: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(estimate, lowest, highest) of the inner product of each query with each coded vector."""
    d = query.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * np.float32(2 / np.sqrt(d)) - np.float32(1 / np.sqrt(d))
    return _bounds((query @ rotation(d, seed)).astype(np.float32), signs, correction.astype(np.float32))


def _bounds(turned: np.ndarray, signs: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = turned @ signs.T
    slack = np.sqrt(np.maximum(0, 1 - a * a)) * np.sqrt(np.maximum(0, 1 - b * b)) + np.float32(SLACK)
    return b / a, a * b - slack, a * b + slack


def near_pairs(left: np.ndarray, right: np.ndarray, threshold: float, same: bool, bits: np.ndarray | None = None, correction: np.ndarray | None = None):
    """Yield (i, j, pairs recomputed) of the pairs with cosine of at least the threshold, some rows
    of `left` at a time; with `same` both sides are one block and i < j. bits and correction are the
    stored codes of `right`."""
    if bits is None:
        bits, correction = codes(right)
    d = right.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * np.float32(2 / np.sqrt(d)) - np.float32(1 / np.sqrt(d))
    turned, a32 = (left @ rotation(d)).astype(np.float32), correction.astype(np.float32)
    for i in range(0, len(left), 256):
        rows = left[i : i + 256]
        _, low, high = _bounds(turned[i : i + 256], signs, a32)
        a, b = np.nonzero(high >= threshold)
        if same:
            keep = a + i < b
            a, b = a[keep], b[keep]
        certain = low[a, b] >= threshold
        for k in range(0, len(a), 1 << 16):
            x, y, sure = a[k : k + (1 << 16)], b[k : k + (1 << 16)], certain[k : k + (1 << 16)].copy()
            open_ = np.flatnonzero(~sure)
            sure[open_] = np.einsum("ij,ij->i", rows[x[open_]], right[y[open_]]) >= threshold
            yield x[sure] + i, y[sure], len(open_)


def _matrix(column) -> np.ndarray:
    """Lists of equal length as rows, without an object for a number."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(e: np.ndarray) -> np.ndarray:
    e = e / np.abs(e).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return e / np.linalg.norm(e, axis=1, keepdims=True)


def _coded(reps: DataFrame) -> DataFrame:
    """The representatives with their codes and correction factors."""

    def run(batches):
        for batch in batches:
            sizes, code, factor = pc.list_value_length(batch.column("e")).to_numpy(), [None] * batch.num_rows, np.zeros(batch.num_rows)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                bits, factor[at] = codes(_unit(_matrix(batch.column("e").take(pa.array(at)))))
                for i, row in zip(at.tolist(), bits, strict=True):
                    code[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code, pa.binary()), pa.array(factor)], names=[*batch.schema.names, "code", "factor"])

    return reps.mapInArrow(run, StructType([*reps.schema.fields, StructField("code", BinaryType()), StructField("factor", DoubleType())]))


def representatives(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label") -> tuple[DataFrame, DataFrame]:
    """(all rows with what they stand for, distinct comparable vectors with count and least key)."""
    e = F.col("e")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("g").isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(key).alias("k"), F.col(embedding).cast("array<double>").alias("e"), F.col(label).alias("g")).withColumn("usable", usable)
    distinct = rows.where("usable").groupBy("g", "e").agg(F.count("*").alias("n"), F.min("k").alias("first"))
    return rows, distinct.withColumn("rep", F.sha2(F.concat_ws(",", F.col("g").cast("string"), F.transform("e", lambda x: x.cast("string"))), 256))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", embedding: str = "embedding", label: str = "label", block: int = BLOCK) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a
    label, link with nothing and stand alone. Vectors of different lengths do not link. Rows that
    repeat are vectors of their own and link with each other. component_id is the smallest key that
    links reach; a row without a key has a null one unless a keyed row is reached.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows, reps = representatives(vectors, key, embedding, label)
    node = F.struct(F.col("first").isNull().alias("none"), "first", "rep")  # so that a component's least node has its least key
    reps = materialise(_coded(reps.withColumn("node", node).withColumn("part", F.concat_ws("/", F.col("g").cast("string"), F.size("e").cast("string")))), "vectors")
    blocks = reps.groupBy("part").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("int").alias("blocks"))
    dealt = reps.select("node", "n", "e", "code", "factor", "part").join(blocks, "part")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node.rep"), F.col("blocks")).cast("int"))
    work = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = work.select("part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "n", "e", "code", "factor", "own")

    def run(table: pa.Table) -> pa.Table:
        unit = _unit(_matrix(table.column("e")))
        bits = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(unit), -1)
        own, i, j = table.column("own").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        linked, forest = np.zeros(len(unit), np.int64), Forest(len(unit))
        n = table.column("n").to_numpy()
        for x, y, _ in near_pairs(unit[left], unit[right], threshold, i == j, bits[right], table.column("factor").to_numpy()[right]):
            a, b = left[x], right[y]
            np.add.at(linked, a, n[b])
            np.add.at(linked, b, n[a])
            forest.add(a, b)
        a, b = forest.edges()
        met, node = np.flatnonzero(linked), table.column("node").combine_chunks()
        return pa.table({"a": pa.concat_arrays([node.take(pa.array(met)), node.take(pa.array(a))]), "b": pa.concat_arrays([node.take(pa.array(met)), node.take(pa.array(b))]), "m": pa.array(np.concatenate((linked[met], np.zeros(len(a), np.int64))))})

    kind = reps.schema["node"].dataType.simpleString()
    linked = materialise(work.groupBy("part", "i", "j").applyInArrow(run, f"a {kind}, b {kind}, m long"), "links")
    counts = linked.groupBy(F.col("a.rep").alias("r1")).agg(F.sum("m").alias("m"))
    labels = connected_components(linked.where("m = 0"), "a", "b").select(F.col("node.rep").alias("r2"), F.col("component.first").alias("c"), F.lit(True).alias("met"))
    named = reps.join(counts, F.col("node.rep") == F.col("r1"), "left").join(labels, F.col("node.rep") == F.col("r2"), "left")
    named = named.select(F.col("g").alias("g2"), F.col("e").alias("e2"), (F.coalesce("m", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.when(F.col("met"), F.col("c")).otherwise(F.col("first")).alias("component_id"))
    joined = rows.join(named, F.col("usable") & (F.col("g") == F.col("g2")) & (F.col("e") == F.col("e2")), "left")
    component = F.when(F.col("n_links").isNull(), F.col("k")).otherwise(F.col("component_id"))
    return joined.select(F.col("k").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("k") == component, F.lit(False)).alias("kept"))
