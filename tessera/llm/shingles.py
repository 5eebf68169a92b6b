"""Near copies by exact Jaccard similarity of word shingles, over SimHash groups completed by bands.

Candidates are texts that share a cell: the SimHash group of their five-word fingerprints, found by
the vantage-point trees, or one of 20 bands of five MinHash values. The bands complete what the
fingerprints cannot reach: at similarity 0.8 two fingerprints differ in about ten of 64 bits, and a
radius over 13 leaves no part of the bits in which a tree could prune. A pair of similarity 0.8
shares a band with probability 0.9996. Every link is confirmed on the two sets of shingles.

Texts that chains of shared cells connect form a cluster. A cluster is dealt into blocks of bounded
size, mostly one; a block's task holds each text once, takes the texts in order of how many others
share their cells, and compares each with the members of its cells that it is not yet connected to.
So in a group of thousands of near copies a few texts are compared with all, and the rest are
connected by then. Clusters of several blocks are dealt anew, which connects the blocks' groups,
and then all pairs that share a cell and are still apart are compared, block by block. No pair that
shares a cell is left out, whatever the size of the cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.chunks import slices, spread
from tessera.operators.components import connected_components
from tessera.session import materialise, ship_package

SHINGLE, THRESHOLD, SEED, BANDS, ROWS = 5, 0.8, 42, 20, 5
#: Text and texts for which a cluster has one block.
BLOCK_BYTES, BLOCK_TEXTS = 16_000_000, 4096
_A = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = np.random.default_rng(SEED + 1).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 of the shingles; words as in SimHash."""
    return np.unique(simhash.shingle_hashes(text, size))


def bands(hashes: np.ndarray) -> list[int]:
    """A hash of each band of MinHash values."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):  # long texts by parts
        np.minimum(least, (hashes[i : i + 2048, None] * _A + _B).min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) - (1 << 63) for i, row in enumerate(least.reshape(BANDS, ROWS))]


def _signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, node, size, fp, bands) of every row; node stands for the text."""
    source = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("node"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                nodes, known = part.column("node").to_pylist(), {}
                for node, t in zip(nodes, part.column("text").to_pylist(), strict=True):
                    if node not in known:
                        h = simhash.shingle_hashes(t, SHINGLE)
                        known[node] = (8 * len(h), simhash.majority(h), bands(np.unique(h)))
                size, fp, cells = zip(*map(known.__getitem__, nodes), strict=True)
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("node"), pa.array(size, pa.int64()), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(cells, pa.list_(pa.int64()))], names=["k", "node", "size", "fp", "bands"])

    return source.mapInArrow(run, f"k {source.schema['k'].dataType.simpleString()}, node long, size long, fp long, bands array<long>")


def connect(sets: list[np.ndarray], cells: np.ndarray, label: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Links, confirmed, that connect all pairs of at least the similarity among those that share a
    cell and differ in label. sets: ascending shingle hashes; cells: one row a text."""
    n, width = cells.shape
    _, cell = np.unique(cells.ravel(), return_inverse=True)
    held = np.bincount(cell)
    order = np.argsort(cell, kind="stable")
    members, starts = order // width, np.cumsum(held) - held
    cell = cell.reshape(n, width)
    sizes = np.array([len(s) for s in sets])
    flat, begins = np.concatenate(sets), np.cumsum(sizes) - sizes
    _, label = np.unique(label, return_inverse=True)
    found, waiting = [], np.ones(n, bool)
    for i in np.argsort(-held[cell].sum(axis=1), kind="stable").tolist():
        waiting[i] = False
        mine = cell[i][held[cell[i]] > 1]
        near = members[spread(held, starts, mine)]
        near = np.unique(near[waiting[near] & (label[near] != label[i])])
        near = near[np.minimum(sizes[near], sizes[i]) >= threshold * np.maximum(sizes[near], sizes[i])]
        for k in range(0, len(near), 1024):
            at = near[k : k + 1024]
            at = at[label[at] != label[i]]
            if not len(at):
                continue
            if sizes[i]:
                other = flat[spread(sizes, begins, at)]
                place = np.minimum(np.searchsorted(sets[i], other), sizes[i] - 1)
                both = np.add.reduceat(sets[i][place] == other, np.cumsum(sizes[at]) - sizes[at], dtype=np.int64)
                at = at[both / (sizes[at] + sizes[i] - both) >= threshold]
            _, first = np.unique(label[at], return_index=True)  # texts without words are alike
            found += [(i, j) for j in at[first].tolist()]
            label[np.isin(label, label[at])] = label[i]
    return found


def _confirmed(work: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links within the groups (cluster, i, j) of work, which has node, label, cells and text."""

    def run(group: pa.Table) -> pa.Table:
        node, at = np.unique(group.column("node").to_numpy(), return_index=True)  # a text may come from both sides
        group = group.take(pa.array(at))
        cells = np.array(group.column("cells").to_pylist(), np.int64).reshape(len(node), -1)
        found = connect([shingles(t) for t in group.column("text").to_pylist()], cells, group.column("label").to_numpy(), threshold)
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(node[a]), "b": pa.array(node[b])})

    return work.select("cluster", "i", "j", "node", "label", "cells", "text").groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long")


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """(cluster, name): the number of blocks for the rows of each cluster."""
    return rows.groupBy("cluster").agg(F.ceil(F.greatest(F.sum("size") / BLOCK_BYTES, F.count("*") / BLOCK_TEXTS, F.lit(1))).cast("int").alias(name))


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    at = connected_components(links, "a", "b").withColumnRenamed("node", "a")
    return rows.drop("label").join(at, F.col("node") == F.col("a"), "left").withColumn("label", F.coalesce("component", "node")).drop("a", "component")


def _dealt(blocks: str, salt: int):
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(blocks)).cast("int")


def links(held: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b): links that connect all texts of a cluster which share a cell and have the similarity.
    held: node (once), cluster, size, cells, text."""
    dealt = materialise(held.join(_blocks(held, "blocks"), "cluster").withColumn("label", F.col("node")), "clusters")
    found = materialise(_confirmed(dealt.withColumn("i", _dealt("blocks", 1)).withColumn("j", F.lit(0)), threshold), "links")
    many = dealt.where("blocks > 1")
    if many.isEmpty():
        return found
    again = _labelled(many, found).withColumn("i", _dealt("blocks", 2)).withColumn("j", F.lit(0))
    found = materialise(found.unionByName(_confirmed(again, threshold)), "links")
    left = materialise(_labelled(many, found), "labels")
    counts = left.groupBy("cluster", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("cluster").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    left = left.join(main, "cluster").withColumn("apart", F.col("label") != F.col("main"))
    cells = left.select("node", "label", "apart", F.explode(F.array_distinct("cells")).alias("cell"))
    mixed = cells.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("apart").alias("any")).where("any and low <> high").select("cell")
    left = materialise(left.join(cells.join(mixed, "cell", "left_semi").select("node").distinct(), "node", "left_semi"), "apart")
    sides = _blocks(left, "is").join(_blocks(left.where("apart"), "js"), "cluster")
    left = left.join(sides, "cluster")
    each = left.withColumn("i", _dealt("is", 1)).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("js") - 1)))
    far = left.where("apart").withColumn("j", _dealt("js", 2)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("is") - 1)))
    return found.unionByName(materialise(_confirmed(each.unionByName(far.select(each.columns)), threshold), "links"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row, the first by key, of each group of texts that links of the similarity connect.

    Texts without a word, null ones too, are alike. Rows without a key come last in their group and
    stay where no other row is in it; repeated rows are cut to one, and different texts that share a
    key are told apart. An empty table gives an empty one.
    """
    ship_package(docs.sparkSession)
    marked = materialise(_signatures(docs, key, text), "signatures")
    order = F.struct(F.col("k").isNull().alias("none"), F.col("k").alias("key"))
    nodes = marked.groupBy("node").agg(F.min(order).alias("order"), *[F.first(c).alias(c) for c in ("size", "fp", "bands")])
    alike = simhash.components(marked.select("k", "fp"), "k").select("fp", F.xxhash64("c.fp", F.lit(SHINGLE)).alias("group"))
    nodes = materialise(nodes.join(alike, "fp").select("node", "order", "size", F.concat("bands", F.array("group")).alias("cells")), "texts")
    cells = nodes.select("node", F.explode("cells").alias("cell"))
    shared = cells.groupBy("cell").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("cell", "least")
    clusters = connected_components(cells.join(shared, "cell").select("node", "least"), "node", "least").withColumnRenamed("component", "cluster")
    wanted = clusters.join(nodes, "node").select("node", "cluster", "size", "cells", F.col("order.key").alias("k"))
    texts = docs.select(F.xxhash64(text).alias("n"), F.col(key).alias("kk"), F.col(text).alias("text"))
    held = wanted.join(texts, (F.col("node") == F.col("n")) & F.col("k").eqNullSafe(F.col("kk"))).dropDuplicates(["node"])
    at = connected_components(links(held.select("node", "cluster", "size", "cells", "text"), threshold), "a", "b").withColumnRenamed("node", "a")
    named = nodes.select("node", "order").join(at, F.col("node") == F.col("a"), "left")
    best = named.groupBy(F.coalesce("component", "node").alias("group")).agg(F.min(F.struct("order", "node")).alias("r"))
    best = best.select(F.col("r.node").alias("__node"), F.col("r.order.key").alias("__key"))
    rows = docs.withColumn("__n", F.xxhash64(text))
    kept = rows.join(best, (F.col("__n") == F.col("__node")) & rows[key].eqNullSafe(F.col("__key")), "left_semi")
    return kept.dropDuplicates([key, "__n"]).drop("__n")
