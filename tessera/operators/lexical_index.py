"""A stored inverted index: written once, opened by many queries, grown by segments.

Each task cuts the documents that it reads into blocks of BLOCK and inverts them there, so texts are not
shuffled. A row of the postings table is one term in one block: the places of the documents that hold
it, and how often, with the greatest frequency and the least length, which bound what the term can add
to any document of the block. Keys and lengths stand once a document. Rows are written by ranges of
(term, block), so a term's rows lie together and a frequent term is many rows; a scan with a few terms
reads the row groups whose term ranges hold them.

A search first scores documents by the rarest terms of each query alone. The k-th best of these partial
scores is a floor under the k-th best score. Blocks are the same documents for every term of a segment,
so the sum of a query's bounds in a block tops every document of it; blocks below the floor are not
scored. That loses nothing: the result is the scan's. The rows of the queries' terms are dealt by block,
and a task keeps its k best of each query, so no row is made for a query and a document or a block.

A segment counts once the manifest names it, and the manifest is replaced whole; what a failed build
left is never read. Statistics are sums over segments, so adding documents rewrites nothing.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.retrieval import MARKS, WAITING, ranked
from tessera.session import materialise, ship_package
from tessera.sources.tables import publish_json

BLOCK, SEEDS = 64, 4
K1, B = 1.5, 0.75


class Index:
    """An index folder as its manifest has it now."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        found = spark.read.option("wholetext", True).text(f"{self.folder}/manifest.json").first()
        self.segments = json.loads(found[0])["segments"]

    def table(self, name: str) -> DataFrame:
        """postings, terms or documents of all segments, with the segment's number."""
        parts = [self.spark.read.parquet(f"{self.folder}/{s['name']}/{name}").withColumn("segment", F.lit(i)) for i, s in enumerate(self.segments)]
        return reduce(DataFrame.unionByName, parts)

    @property
    def documents(self) -> int:
        return sum(s["documents"] for s in self.segments)

    @property
    def mean_length(self) -> float:
        return max(1.0, sum(s["tokens"] for s in self.segments) / max(1, self.documents))


def create(spark: SparkSession, folder: str) -> None:
    """An empty index; a folder that has one already is an error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/manifest.json")
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        raise FileExistsError(folder)
    publish_json(spark, f"{folder.rstrip('/')}/manifest.json", {"segments": []})


def _write(postings: DataFrame, folder: str) -> None:
    postings.repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.option("compression", "zstd").parquet(f"{folder}/postings")
    held = postings.sparkSession.read.parquet(f"{folder}/postings").select("term", F.size("tf").alias("n"), "most_tf", "least_len")
    terms = held.groupBy("term").agg(F.sum("n").alias("df"), F.max("most_tf").alias("most_tf"), F.min("least_len").alias("least_len"))
    terms.repartitionByRange("term").sortWithinPartitions("term").write.option("compression", "zstd").parquet(f"{folder}/terms")


def _inverted(keys: pa.Array, tokens: pa.Array, block: int) -> list:
    """(term, key, at, tf, most_tf, least_len) of one block as Arrow arrays: a row for each document, without
    term and its length as tf, then one for each term."""
    lens = np.diff(tokens.offsets.to_numpy()).astype(np.int64)
    coded, n = tokens.flatten().dictionary_encode(), len(lens)
    cells, tf = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n + np.repeat(np.arange(n), lens), return_counts=True)
    term, at = cells // max(1, n), cells % max(1, n)
    begins = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(tf, begins) if len(term) else tf
    least = np.minimum.reduceat(lens[at], begins) if len(term) else tf
    bounds = pa.array(np.r_[np.arange(n), n + begins, n + len(at)], pa.int32())
    lists = lambda own, kind, mine: pa.ListArray.from_arrays(bounds, pa.array(np.r_[own, mine], kind))
    return [
        pa.concat_arrays([pa.nulls(n, pa.string()), coded.dictionary.take(pa.array(term[begins], pa.int64())).cast(pa.string())]),
        pa.concat_arrays([keys, pa.nulls(len(begins), keys.type)]),
        lists(np.arange(n), pa.int16(), at),
        lists(lens, pa.int32(), tf),
        pa.array(np.r_[np.zeros(n, np.int64), most], pa.int32()),
        pa.array(np.r_[np.zeros(n, np.int64), least], pa.int32()),
    ]


def add(spark: SparkSession, folder: str, docs: DataFrame, key: str, tokens: Column, block: int = BLOCK) -> None:
    """Documents as one more segment. Keys must be new and unique, which is checked; a null key is an
    error, a document without tokens counts in the statistics alone."""
    index, name = Index(spark, folder), f"segment-{uuid.uuid4().hex}"
    target = f"{index.folder}/{name}"
    if not 0 < block < 1 << 15:
        raise ValueError("a block has up to 32,767 documents")
    ship_package(spark)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
    names = ["block", "term", "key", "at", "tf", "most_tf", "least_len"]

    def invert(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                arrays = _inverted(part.column(0), pa.concat_arrays([part.column(1)]), block)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(arrays[0]), number), pa.int64()), *arrays], names=names)
                number += 1

    made = materialise(rows.mapInArrow(invert, f"block long, term string, key {rows.schema['key'].dataType.simpleString()}, at array<smallint>, tf array<int>, most_tf int, least_len int"), "inverted")
    known = made.where("term IS NULL").select("key", F.col("tf")[0].alias("len"), "block", F.col("at")[0].alias("at"))
    n, distinct, length = known.agg(F.count("*"), F.count_distinct("key"), F.coalesce(F.sum("len"), F.lit(0))).first()
    if n != distinct or (index.segments and not known.join(index.table("documents").select("key"), "key", "left_semi").isEmpty()):
        raise ValueError("document keys of an index are unique and not null")
    known.write.option("compression", "zstd").parquet(f"{target}/documents")
    grouped = made.where("term IS NOT NULL").select("term", "block", "at", "tf", "most_tf", "least_len")
    _write(grouped, target)
    publish_json(spark, f"{index.folder}/manifest.json", {"segments": [*index.segments, {"name": name, "documents": n, "tokens": length}]})


def merge(spark: SparkSession, folder: str) -> None:
    """All segments as one; their blocks stay as they are, under new numbers."""
    index, name = Index(spark, folder), f"segment-{uuid.uuid4().hex}"
    if len(index.segments) < 2:
        return
    target = f"{index.folder}/{name}"
    starts, at = [], 0
    for r in sorted(index.table("documents").groupBy("segment").agg(F.max("block").alias("last")).collect(), key=lambda r: r.segment):  # one row a segment
        starts.append((r.segment, at))
        at += (r.last or 0) + 1
    offset = F.coalesce(*[F.when(F.col("segment") == s, a) for s, a in starts])
    moved = lambda t: index.table(t).withColumn("block", F.col("block") + offset).drop("segment")
    moved("documents").write.option("compression", "zstd").parquet(f"{target}/documents")
    _write(moved("postings"), target)
    publish_json(spark, f"{index.folder}/manifest.json", {"segments": [{"name": name, "documents": index.documents, "tokens": sum(s["tokens"] for s in index.segments)}]})


def _impact(tf, length, mean: float):
    """What a term of weight one adds; it grows with tf and falls with the length."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def _best(waiting: list[tuple], k: int) -> tuple:
    """Queries, scores and keys of the k best of each query; ties go to the smaller key."""
    q, s, key = (np.concatenate(x) for x in zip(*waiting, strict=True))
    order = np.lexsort((key, -s, q))
    q, s, key = q[order], s[order], key[order]
    begins = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    kept = np.arange(len(q)) - np.repeat(begins, np.diff(np.r_[begins, len(q)])) < k
    return q[kept], s[kept], key[kept]


def _scored(index: Index, coded: DataFrame, weights: np.ndarray, floors: np.ndarray, k: int) -> DataFrame:
    """(__q, key, score, blocks, read) of each task's k best of each query, and one row of counts a task.

    coded(term, code); weights[code, q], zero where a query lacks the term. The documents of a block come
    to its task before the rows of its terms; a task holds one Arrow batch, one block and its k best."""
    spark, mean = index.spark, index.mean_length
    docs, held = index.table("documents"), index.table("postings").join(F.broadcast(coded), "term")
    kind = docs.schema["key"].dataType.simpleString()
    none = F.lit(None)
    rows = docs.select("segment", "block", F.lit(-1).alias("code"), "key", F.array("at").alias("at"), F.array("len").alias("tf"), F.lit(0).alias("most_tf"), F.lit(0).alias("least_len"))
    rows = rows.unionByName(held.select("segment", "block", "code", none.cast(kind).alias("key"), "at", "tf", "most_tf", "least_len"))
    rows = rows.repartition("segment", "block").sortWithinPartitions("segment", "block", "code")
    shared = spark.sparkContext.broadcast((weights, floors))

    def flat(column, start, stop):
        at = column.offsets.to_numpy()
        return column.values.to_numpy(zero_copy_only=False)[at[start] : at[stop]], np.diff(at[start : stop + 1])

    def run(batches):
        weights_, floor = shared.value
        floor, waiting, size, blocks, read, kept, key_type = floor.copy(), [], 0, 0, 0, None, None
        for batch in _and_none(batches):
            if batch is not None:
                if not batch.num_rows:
                    continue
                key_type = batch.schema.field("key").type
                kept = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            if kept is None:
                break
            kept = kept.combine_chunks()
            segment, number, code, most, least = (kept.column(c).to_numpy() for c in ("segment", "block", "code", "most_tf", "least_len"))
            key, at, tf = (kept.column(c).chunk(0) for c in ("key", "at", "tf"))
            cuts = np.r_[0, 1 + np.flatnonzero((segment[1:] != segment[:-1]) | (number[1:] != number[:-1])), len(number)]
            whole = cuts if batch is None else cuts[:-1]  # the last block may go on in the next batch
            for start, stop in zip(whole[:-1], whole[1:], strict=True):
                first = start + np.count_nonzero(code[start:stop] < 0)
                if first == stop:
                    continue
                own = code[first:stop]
                w = weights_[own]
                tops = _impact(most[first:stop].astype(float), least[first:stop], mean) @ w
                asked = tops > 0
                open_ = np.flatnonzero(asked & (tops >= floor))
                blocks, read = blocks + np.count_nonzero(asked), read + len(open_)
                if not len(open_):
                    continue
                places, _ = flat(at, start, first)
                lens = np.zeros(first - start)
                lens[places] = flat(tf, start, first)[0]
                keys = np.array(key.slice(start, first - start).to_pylist())[np.argsort(places)]
                p, n = flat(at, first, stop)
                f = flat(tf, first, stop)[0].astype(float)
                tile = np.zeros((len(own), len(lens)))
                tile[np.repeat(np.arange(len(own)), n), p] = _impact(f, lens[p], mean)
                scores = np.round(tile.T @ w[:, open_], 6)
                d, q = np.nonzero((scores > 0) & (scores >= floor[open_]))
                if len(d):
                    waiting.append((open_[q], scores[d, q], keys[d]))
                    size += len(d)
                if size > max(WAITING, 2 * k * len(floor)):
                    waiting = [_best(waiting, k)]
                    size = len(waiting[0][0])
                    met, counts = np.unique(waiting[0][0], return_counts=True)
                    for x in met[counts == k]:
                        floor[x] = max(floor[x], waiting[0][1][waiting[0][0] == x].min() - 1e-6)
            kept = kept.slice(whole[-1]) if batch is not None else None
        if key_type is None:
            return
        q, s, keys = _best(waiting, k) if waiting else (np.zeros(0, int), np.zeros(0), np.zeros(0))
        none_ = [None] * len(q)
        yield pa.RecordBatch.from_arrays([pa.array([*q.tolist(), None], pa.int32()), pa.array([*keys.tolist(), None], key_type), pa.array([*s.tolist(), None], pa.float64()), pa.array([*none_, int(blocks)], pa.int64()), pa.array([*none_, int(read)], pa.int64())], names=["__q", "key", "score", "blocks", "read"])

    return materialise(rows.mapInArrow(run, f"__q int, key {kind}, score double, blocks long, read long"), "scored")


def _and_none(batches):
    yield from batches
    yield None


def search(index: Index, queries: DataFrame, query_key: str, tokens: Column, k: int, key: str = "key", seeds: int = SEEDS, most: int = 2_000, turn: int = 0) -> tuple[DataFrame, DataFrame]:
    """(query_key, key, score, rank) of the k best, as `bm25` over all documents gives them, and a row
    (blocks, read): pairs of a query and a block that holds one of its terms, and those scored.

    Up to `most` queries, a checked bound, go to every task with their terms' weights; more are taken
    in turns."""
    spark = queries.sparkSession
    ship_package(spark)
    kind = queries.schema[query_key].dataType.simpleString()
    n = index.documents
    if not n:
        return spark.createDataFrame([], f"{query_key} {kind}, {key} string, score double, rank int"), spark.createDataFrame([(0, 0)], "blocks long, read long")
    asked = queries.select(F.col(query_key).alias("q"), F.array_distinct(tokens).alias("terms"))
    total = asked.count()

    def in_turns(most):
        parts = -(-total // most) * 2
        own = F.pmod(F.xxhash64(query_key, F.lit(turn)), F.lit(parts))
        found, counts = zip(*[search(index, queries.where(own == i), query_key, tokens, k, key, seeds, most, turn + 1) for i in range(parts)], strict=True)
        return reduce(DataFrame.unionByName, found), reduce(DataFrame.unionByName, counts).agg(F.sum("blocks").alias("blocks"), F.sum("read").alias("read"))

    if total > most:
        return in_turns(most)
    got = asked.toArrow()
    keys, lists = got.column(0).to_pylist(), got.column(1).to_pylist()
    words = sorted({t for x in lists for t in x or ()})
    if total > 1 and total * len(words) > MARKS:
        return in_turns(total // 2)
    names = {x: i for i, x in enumerate(dict.fromkeys(keys))}
    wanted = spark.createDataFrame([(t,) for t in words], "term string")
    df = {r.term: r.df for r in index.table("terms").join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}  # the queries' terms
    place = {t: i for i, t in enumerate(sorted(df))}
    weights, rarest = np.zeros((len(place), len(names))), np.zeros((len(place), len(names)))
    for x, terms in zip(keys, lists, strict=True):
        for t in terms or ():
            if t in place:
                weights[place[t], names[x]] += np.log1p((n - df[t] + 0.5) / (df[t] + 0.5))
    order = sorted(place, key=lambda t: (df[t], t))
    for q in range(len(names)):
        few = [place[t] for t in order if weights[place[t], q]][:seeds]
        rarest[few, q] = weights[few, q]
    coded = lambda held: spark.createDataFrame([(t, i) for t, i in place.items() if held[i].any()], "term string, code int")
    # A floor under each query's k-th score; scores that are equal when rounded count as equal.
    first = _scored(index, coded(rarest), rarest, np.full(len(names), -np.inf), k).where("__q IS NOT NULL")
    best = first.withColumn("r", F.row_number().over(Window.partitionBy("__q").orderBy(F.desc("score")))).where(F.col("r") == k)
    floors = np.full(len(names), -np.inf)
    for r in best.select("__q", "score").collect():  # one row a query
        floors[r["__q"]] = r.score - 2e-6
    local = _scored(index, coded(weights), weights, floors, k)
    called = spark.createDataFrame([(i, x) for x, i in names.items()], f"__q int, {query_key} {kind}")
    hits = local.where("__q IS NOT NULL").join(F.broadcast(called), "__q").select(query_key, F.col("key").alias(key), "score")
    return ranked(hits, query_key, key, k), local.agg(F.coalesce(F.sum("blocks"), F.lit(0)).alias("blocks"), F.coalesce(F.sum("read"), F.lit(0)).alias("read"))
