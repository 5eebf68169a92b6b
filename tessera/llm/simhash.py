"""Near-duplicate search by SimHash fingerprints and vantage-point trees.

Hamming distance over a part of the bits is a metric too, and two fingerprints within the radius
are at distance zero in some part when the bits are cut into more parts than the radius has. So
each fingerprint goes to one cell in each of a few tables, by the bits of some parts; how many parts
a table uses follows from the number of fingerprints alone, so that cells stay small at every size
and the tables, 5 to 70 of them, stay complete.

A cell is partitioned by the full Hamming distance from a vantage point of its own, in shells of
eight. As |d(x, v) - d(y, v)| <= d(x, y), a pair crosses a shell's boundary only from within the
radius of it: those fingerprints are guests of the next shell and are queried there. Within a shard
(one shell of one cell) a vantage-point tree splits at the median distance, sends to the far side
only what the triangle bound lets lie within the radius of the boundary, and compares its leaves
exactly. A shard with very many fingerprints is worked off as pairs of blocks of bounded size.

Only a spanning forest of the links of a shard leaves its task, each edge a true link: a group of
thousands of near copies gives as many edges as members, never all pairs. Components are then
joined by star contraction.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.operators.components import connected_components
from tessera.llm.chunks import slices
from tessera.session import materialise, ship_package

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Members of a leaf of the tree; fingerprints that a cell should hold; shell width; members of a block.
LEAF, CELL, SHELL, BLOCK = 32, 1024, 8, 32_768
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str | None, shingle: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle in order, repeats included.

    Words are runs of anything but ASCII white space, after A-Z are lower-cased. Fewer words than a
    shingle make one shingle; no word, null and empty give none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(words) - shingle + 1)
    data, digest = b" ".join(words), xxhash.xxh64_intdigest
    return np.array([digest(data[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; zero if there are none."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):  # long texts by parts
        total += np.unpackbits(hashes[i : i + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text: a bit is set if it is set in over half of the shingles' XXH64."""
    return majority(shingle_hashes(text, shingle))


def _with_fingerprint(source: DataFrame, text: str, column: str) -> DataFrame:
    """All columns of source and the fingerprint of `text`, its bits as a signed number."""
    ship_package(source.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                fp = np.array([fingerprint(t) for t in part.column(text).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fp.view(np.int64))], names=[*part.schema.names, column])

    return source.mapInArrow(run, StructType([*source.schema.fields, StructField(column, LongType())]))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp long) of every row."""
    return _with_fingerprint(docs.select(F.col(key).alias("k"), F.col(text).alias("text")), "text", "fp").select(F.col("k").alias(key), "fp")


class Forest:
    """A spanning forest of links between positions: each position's label is the smallest position
    that links reach, and the edges kept are links that joined two trees. Counts what a tree search
    compared and what the triangle bound let it leave out."""

    def __init__(self, n: int):
        self.label, self._edges = np.arange(n), []
        self.compared = self.pruned = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, high, low = a[differ], b[differ], np.maximum(x, y)[differ], np.minimum(x, y)[differ]
            order = np.lexsort((low, high))
            first = order[np.concatenate(([True], high[order][1:] != high[order][:-1]))]
            self._edges.append((a[first], b[first]))  # each tree is hooked to a smaller one, once
            label[high[first]] = low[first]
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        if not self._edges:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*self._edges, strict=True))


def _compare(fp: np.ndarray, home: np.ndarray, other: np.ndarray, radius: int, forest: Forest, within: bool) -> None:
    """Link members of home with those of other and, if `within`, of home."""
    both = np.concatenate((home, other)) if within else other
    for i in range(0, len(home), 256):
        rows = home[i : i + 256]
        near = np.bitwise_count(fp[rows][:, None] ^ fp[both][None, :]) <= radius
        forest.compared += near.size
        a, b = np.nonzero(near)
        forest.add(rows[a], both[b])


def tree_links(fp: np.ndarray, home: np.ndarray, other: np.ndarray, radius: int, forest: Forest, within: bool = True) -> None:
    """Vantage-point tree over home, which `other` is queried against; with `within` home's own pairs
    are found too. fp holds no fingerprint twice among home.

    A branch gets from the far side of its boundary what the triangle bound lets lie within the
    radius of it, each pair on one side alone.
    """
    stack = [(home, other)]
    while stack:
        home, other = stack.pop()
        if len(home) <= LEAF:
            if len(home) and (within or len(other)):
                _compare(fp, home, other, radius, forest, within)
            continue
        vantage = fp[home[0]]
        dh, do = np.bitwise_count(fp[home] ^ vantage).astype(np.int64), np.bitwise_count(fp[other] ^ vantage).astype(np.int64)
        edge = int(np.median(dh))
        if edge == dh.max():
            edge -= 1  # the vantage point itself is at zero, all others are not
        low = dh <= edge
        inner, outer = home[low], home[~low]
        crossing = outer[dh[~low] <= edge + radius] if within else outer[:0]
        inner_other, outer_other = other[do <= edge + radius], other[do > edge - radius]
        forest.pruned += (len(outer) - len(crossing) if within else 0) + 2 * len(other) - len(inner_other) - len(outer_other)
        stack += [(inner, np.concatenate((inner_other, crossing))), (outer, outer_other)]


def tables(n: int, radius: int = RADIUS, cell: int = CELL) -> list[int]:
    """Bit masks, one a table: two fingerprints within the radius agree on all bits of some mask, and
    n fingerprints spread over its bits leave about `cell` of them in each cell."""
    need = max(0, math.ceil(math.log2(max(1, n) / cell)))
    if not need:
        return [0]
    for parts in range(radius + 1, radius + 5):
        bounds = [64 * i // parts for i in range(parts + 1)]
        agree = parts - radius
        if 64 // parts * agree >= need or parts == radius + 4:
            each = min(64 // parts, math.ceil(need / agree))
            return [sum(((1 << each) - 1) << bounds[i] for i in chosen) for chosen in itertools.combinations(range(parts), agree)]


def links(distinct: DataFrame, radius: int = RADIUS, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """(a, b): links between the fingerprints in column fp, each within the radius, that connect all
    that a chain of links connects. distinct: no fingerprint twice."""
    if not 0 <= radius < SHELL:
        raise ValueError("the radius must be less than a shell's width")
    ship_package(distinct.sparkSession)
    signed = [m - (1 << 64) if m >> 63 else m for m in tables(distinct.count(), radius, cell)]
    cells = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])
    placed = distinct.select("fp", F.explode(cells).alias("cell"))
    away = F.bit_count(F.col("fp").bitwiseXOR(F.xxhash64("cell", F.lit(7))))  # a cell's vantage point
    shell = F.floor(away / SHELL).cast("int")
    guest = (away + radius) >= (shell + 1) * SHELL
    both = F.when(guest, F.array(F.struct(shell.alias("shell"), F.lit(True).alias("home")), F.struct((shell + 1).alias("shell"), F.lit(False).alias("home")))).otherwise(F.array(F.struct(shell.alias("shell"), F.lit(True).alias("home"))))
    held = placed.select("fp", "cell", F.explode(both).alias("s")).select("fp", "cell", "s.shell", "s.home")
    large = held.groupBy("cell", "shell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).where("blocks > 1")
    dealt = held.join(large, ["cell", "shell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(3)), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = dealt.select("cell", "shell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "home", "own")

    def run(shard: pa.Table) -> pa.Table:
        fp, home, own = shard.column("fp").to_numpy().view(np.uint64), shard.column("home").to_numpy(zero_copy_only=False), shard.column("own").to_numpy()
        forest, first = Forest(len(fp)), own == shard.column("i")[0].as_py()
        if first.all():
            tree_links(fp, np.flatnonzero(home), np.flatnonzero(~home), radius, forest)
        else:
            tree_links(fp, np.flatnonzero(first), np.flatnonzero(~first), radius, forest, within=False)
        a, b = forest.edges()
        signs = fp.view(np.int64)
        return pa.table({"a": pa.array(signs[a]), "b": pa.array(signs[b])})

    return work.groupBy("cell", "shell", "i", "j").applyInArrow(run, "a long, b long")


def components(marked: DataFrame, key: str, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """(fp, c): for each fingerprint in marked the least (no key, key, fp) of its component."""
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "fp")
    reps = materialise(marked.groupBy("fp").agg(F.min(order).alias("node")), "fingerprints")
    near = links(reps.select("fp"), radius, cell)
    for c in "ab":  # nodes are named by their keys, so that a component's least node has its least key
        near = near.join(reps.select(F.col("fp").alias(c), F.col("node").alias(f"n{c}")), c)
    at = connected_components(near, "na", "nb").select(F.col("node.fp").alias("f"), "component")
    return reps.join(at, F.col("fp") == F.col("f"), "left").select("fp", F.coalesce("component", "node").alias("c"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """(key, fp, component_id) of every row: component_id is the smallest key reachable by links.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows stay. Rows
    without a key keep their place in links, but a component is named by the keys that are not null.
    """
    marked = materialise(fingerprints(docs, key, text), "fingerprints")
    return marked.join(components(marked, key, radius, cell), "fp").select(key, "fp", F.col("c.key").alias("component_id"))


def hex_fingerprint(column: str = "fp"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each group of near copies: that of the least key, those without a key last.

    Repeated rows are cut to one; rows of one key with different fingerprints are told apart, those
    with the same one count as copies.
    """
    marked = materialise(_with_fingerprint(docs, text, "__fp"), "fingerprints")
    best = components(marked.select(F.col(key).alias("k"), F.col("__fp").alias("fp")), "k", radius, CELL).where(F.col("fp") == F.col("c.fp")).select(F.col("fp").alias("__f"), F.col("c.key").alias("__k"))
    kept = marked.join(best, (F.col("__fp") == F.col("__f")) & F.col(key).eqNullSafe(F.col("__k")), "left_semi")
    return kept.dropDuplicates([key, "__fp"]).drop("__fp")
