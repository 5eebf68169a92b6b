"""Bigram language model by deleted interpolation, counted and applied without a global table.

    P(w | v) = l2[b] c(v, w) / c(v)  +  l1[b] c(w) / N  +  l0[b] / (V + 1)

b is the bucket of the context's frequency, one for each power of two. The weights are learnt by
expectation-maximisation on held-out counts: every training token is deleted from the counts in its
turn (one less in c(v, w), c(v), c(w) and N), so all training data serve as held-out data. Each
token's two deleted estimates fall into a cell of a bounded grid that keeps their sums; EM runs over
the cells on the driver.

How it spreads. Documents are dealt into groups by hash. A group finds its distinct tokens and
bigrams, as 64-bit hashes in ascending order, with their training counts, and sends each bucket of
the hash range one packed row. A bucket adds up the counts and answers every group in the group's
own order, one row for each bucket that the group has n-grams in. The groups, whose shuffle is used again, look up each token's counts. So a frequent word
costs a group one entry, whatever its number of occurrences, and no step holds more than one group
or one bucket; both are counted by the bytes of text, and a group sends no more rows than it has
n-grams. What is gathered grows with the distinct n-grams of the input.

Defined results: a null or empty text is one end token; texts are scored whole; repeated rows count
and are scored each; a missing identifier is text for training; with no training text every score
and base score is 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.chunks import chunk_codes, listed
from tessera.session import materialise, ship_package

#: Hashes of the end of a text and of the context before its first token; no word hashes to them by rule.
END, BEGIN = np.uint64(xxhash.xxh64_intdigest(b"\0end", 1)), np.uint64(xxhash.xxh64_intdigest(b"\0begin", 1))
EM_ROUNDS, BUCKETS, BLOCK_TOKENS = 40, 34, 1 << 20
#: Text for which there is one group, held by a worker with all its arrays, and one bucket of hashes.
GROUP_BYTES, BUCKET_BYTES = 6_000_000, 16_000_000


def pack(a: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: the planes of high bytes nearly vanish."""
    width = a.dtype.itemsize
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, width).T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    width, plain = data[0], zstandard.ZstdDecompressor().decompress(data[1:])
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def pack_counts(n: np.ndarray) -> bytes:
    top = int(n.max(initial=0))
    return pack(n.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64))


class Tokens:
    """The token stream of a group of texts: each text's words, then its end."""

    def __init__(self, texts: pa.Array):
        offsets, words, codes = chunk_codes(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        digest = xxhash.xxh64_intdigest
        hashes = np.array([*[digest(w, 1) for w in listed(words)], int(END)], np.uint64)
        sizes = np.diff(offsets)
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        code = np.full(len(codes) + len(sizes), len(words), np.int64)
        inner = np.ones(len(code), bool)
        inner[self.ends] = False
        code[inner] = codes
        self.unigrams, place = np.unique(hashes, return_inverse=True)
        self.token = place[code]  # index into unigrams
        cur = self.unigrams[self.token]
        prev = np.concatenate(([BEGIN], cur[:-1]))
        prev[self.starts] = BEGIN
        mixed = (prev * np.uint64(0x9E3779B97F4A7C15)) ^ (cur + np.uint64(0xD6E8FEB86659FD93))
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        self.bigram = mixed ^ (mixed >> np.uint64(29))

    def of_docs(self, flags: np.ndarray) -> np.ndarray:
        return np.repeat(flags, self.ends - self.starts + 1)


def shares(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the buckets of the hash range that ascending keys fall into."""
    if not len(keys):
        return []
    of = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.concatenate(([0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(keys)]))
    return list(zip(of[cuts[:-1]].astype(np.int64).tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never met, else 1 + the power of two below its frequency."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))).astype(np.int64), 0)


def em(cells: np.ndarray, n_tokens: int, types: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (l2, l1, l0) of each bucket. cells: bucket, tokens, sum of p2, sum of deleted c(w)."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    if not len(cells):
        return weights
    b, n = cells[:, 0].astype(np.int64), cells[:, 1]
    p = np.stack([cells[:, 2] / n, cells[:, 3] / n / max(1, n_tokens - 1), np.full(len(b), 1 / (types + 1))], axis=1)
    overall = np.full(3, 1 / 3)
    for _ in range(rounds):
        share = weights[b] * p
        share *= (n / share.sum(axis=1))[:, None]
        got = np.zeros((BUCKETS, 3))
        np.add.at(got, b, share)
        overall = got.sum(axis=0) / got.sum()
        got += overall  # one token of prior weight, for buckets that training leaves empty
        weights = got / got.sum(axis=1, keepdims=True)
    weights[0, 1:] += weights[0, 0] * weights[0, 1:] / weights[0, 1:].sum()
    weights[0, 0] = 0
    return weights


def count(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text", groups: int | None = None) -> DataFrame:
    """A table of token counts by blocks of documents, with the model's grid and totals.

    Rows of kind 0 hold a block: identifiers, held-out flags, numbers of tokens and of known tokens,
    sums of log10(c + 0.5), packed counts c(w) and c(v, w) of all its tokens and the count of texts
    in training; kind 1 the cells of a group; kind 2 a bucket's training tokens and types.
    """
    spark = docs.sparkSession
    ship_package(spark)
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = groups or max(1, -(-size // GROUP_BYTES))
    buckets = max(1, -(-size // BUCKET_BYTES))
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    source = source.withColumn("g", F.pmod(F.xxhash64("k", "text"), F.lit(n).cast("long")).cast("int"))

    def ask(table: pa.Table) -> pa.Table:
        t = Tokens(table.column("text").combine_chunks())
        train = t.of_docs(~table.column("held").to_numpy(zero_copy_only=False))
        g = table.column("g")[0].as_py()
        rows = []
        begins = np.array([(~table.column("held").to_numpy(zero_copy_only=False)).sum()])
        unigrams = np.bincount(t.token, weights=train, minlength=len(t.unigrams)).astype(np.int64)
        order = np.argsort(t.bigram, kind="stable")
        keys = t.bigram[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        bigrams = np.add.reduceat(train[order].astype(np.int64), first)
        for kind, ks, cs in ((1, t.unigrams, unigrams), (2, keys[first], bigrams), (3, np.array([BEGIN]), begins)):
            rows += [{"bucket": k, "g": g, "kind": kind, "keys": pack_keys(ks[a:b]), "counts": pack_counts(cs[a:b])} for k, a, b in shares(ks, buckets)]
        return pa.Table.from_pylist(rows, schema=pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    def answer(table: pa.Table) -> pa.Table:
        rows, k = [], table.column("bucket")[0].as_py()
        asked, kinds = table.column("g").to_pylist(), table.column("kind").to_numpy()
        for kind in (1, 2, 3):
            at = np.flatnonzero(kinds == kind)
            if not len(at):
                continue
            keys = [unpack_keys(table.column("keys")[int(i)].as_py()) for i in at]
            counts = np.concatenate([unpack(table.column("counts")[int(i)].as_py()).astype(np.int64) for i in at])
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
            ends = np.cumsum([len(x) for x in keys])
            for i, a, b in zip(at, [0, *ends[:-1]], ends, strict=True):
                rows.append({"g": asked[i], "kind": kind, "bucket": k, "counts": pack_counts(total[place[a:b]]), "tokens": 0, "types": 0})
            if kind == 1:
                rows.append({"g": -1 - k, "kind": 0, "bucket": k, "counts": b"", "tokens": int(total.sum()), "types": int((total > 0).sum())})
        return pa.Table.from_pylist(rows, schema=pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64())]))

    lists = {"ids": source.schema["k"].dataType.simpleString(), "held": "boolean", "n_tokens": "long", "n_known": "long", "base": "double"}
    out = "kind int, tokens long, types long, begins long, " + ", ".join(f"{c} array<{k}>" for c, k in lists.items()) + ", unigrams binary, bigrams binary, cell array<long>, cell_n array<long>, cell_p2 array<double>, cell_w array<double>"

    def look_up(table: pa.Table, answers: pa.Table) -> pa.Table:
        kinds = answers.column("kind").to_numpy()
        rows = [{"kind": 2, "tokens": answers.column("tokens")[int(i)].as_py(), "types": answers.column("types")[int(i)].as_py()} for i in np.flatnonzero(kinds == 0)]
        if table.num_rows:
            t = Tokens(table.column("text").combine_chunks())
            buckets = answers.column("bucket").to_numpy()
            got = {}
            for kind in (1, 2, 3):
                at = np.flatnonzero(kinds == kind)
                at = at[np.argsort(buckets[at])]
                got[kind] = np.concatenate([unpack(answers.column("counts")[int(i)].as_py()).astype(np.int64) for i in at])
            begins = int(got[3][0])
            cw = got[1][t.token]
            distinct, place = np.unique(t.bigram, return_inverse=True)
            c2 = got[2][place]
            if len(got[2]) != len(distinct) or len(got[1]) != len(t.unigrams):
                raise ValueError("answers do not fit the group")
            cv = np.concatenate(([begins], cw[:-1]))
            cv[t.starts] = begins
            held = table.column("held").to_numpy(zero_copy_only=False)
            train = t.of_docs(~held)
            left, p1 = cv[train] - 1, cw[train] - 1
            p2 = np.where(left > 0, (c2[train] - 1) / np.maximum(left, 1), 0.0)
            cell = (bucket(left) * 128 + np.where(p2 > 0, np.clip(127 + np.floor(2 * np.log2(np.where(p2 > 0, p2, 1))), 1, 127), 0).astype(np.int64)) * 64 + bucket(p1)
            cells, at = np.unique(cell, return_inverse=True)
            rows.append({"kind": 1, "cell": cells, "cell_n": np.bincount(at, minlength=len(cells)), "cell_p2": np.bincount(at, weights=p2, minlength=len(cells)), "cell_w": np.bincount(at, weights=p1, minlength=len(cells))})
            known = np.add.reduceat((cw > 0).astype(np.int64), t.starts)
            base = np.add.reduceat(np.log10(cw + 0.5), t.starts)
            ids = table.column("k").combine_chunks()
            a = 0
            while a < len(t.starts):
                b = max(a + 1, int(np.searchsorted(t.ends, t.starts[a] + BLOCK_TOKENS)))
                x, y = t.starts[a], t.ends[b - 1] + 1
                rows.append({"kind": 0, "begins": begins, "ids": ids.slice(a, b - a).to_pylist(), "held": held[a:b], "n_tokens": (t.ends - t.starts + 1)[a:b], "n_known": known[a:b], "base": base[a:b], "unigrams": pack_counts(cw[x:y]), "bigrams": pack_counts(c2[x:y])})
                a = b
        return pa.Table.from_pylist(rows, schema=arrow)

    arrow = pa.schema(
        [("kind", pa.int32()), ("tokens", pa.int64()), ("types", pa.int64()), ("begins", pa.int64())]
        + [(c, pa.list_(to_arrow_type(source.schema["k"].dataType) if c == "ids" else {"boolean": pa.bool_(), "long": pa.int64(), "double": pa.float64()}[k])) for c, k in lists.items()]
        + [("unigrams", pa.binary()), ("bigrams", pa.binary()), ("cell", pa.list_(pa.int64())), ("cell_n", pa.list_(pa.int64())), ("cell_p2", pa.list_(pa.float64())), ("cell_w", pa.list_(pa.float64()))]
    )
    asked = source.groupBy("g").applyInArrow(ask, "bucket int, g int, kind int, keys binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(answer, "g int, kind int, bucket int, counts binary, tokens long, types long")
    return materialise(source.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(look_up, out), "counts")


def score(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text", groups: int | None = None) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    held_out: a boolean Column; rows where it is true are not learnt from.
    """
    spark = docs.sparkSession
    table = count(docs, held_out, key, text, groups)
    totals = table.where("kind = 2").agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    n, v = int(totals["n"] or 0), int(totals["v"] or 0)
    cells = table.where("kind = 1").select(F.explode(F.arrays_zip("cell", "cell_n", "cell_p2", "cell_w")).alias("c")).groupBy("c.cell").agg(F.sum("c.cell_n").alias("n"), F.sum("c.cell_p2").alias("p2"), F.sum("c.cell_w").alias("w"))
    grid = np.array([(r["cell"] >> 13, r["n"], r["p2"], r["w"]) for r in sorted(cells.collect(), key=lambda r: r["cell"])], np.float64)  # the grid is bounded: 34 x 128 x 64 cells
    weights = em(grid, n, v) if n else np.full((BUCKETS, 3), 1 / 3)
    shift = math.log10(n + 0.5 * (v + 1))
    key_type = table.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i] for c in ("begins", "ids", "held", "n_tokens", "n_known", "base", "unigrams", "bigrams")}
                sizes = r["n_tokens"].values.to_numpy()
                starts = np.cumsum(sizes) - sizes
                cw, c2 = unpack(r["unigrams"].as_py()).astype(np.float64), unpack(r["bigrams"].as_py()).astype(np.float64)
                cv = np.concatenate(([0.0], cw[:-1]))
                cv[starts] = r["begins"].as_py()
                w = weights[bucket(cv)]
                p = w[:, 0] * c2 / np.maximum(cv, 1) + w[:, 1] * cw / max(n, 1) + w[:, 2] / (v + 1)
                if not n:
                    p = np.ones_like(p)
                total = np.add.reduceat(np.log10(p), starts)
                yield pa.RecordBatch.from_arrays(
                    [r["ids"].values, r["held"].values, pa.array(sizes), r["n_known"].values, pa.array(np.full(len(sizes), n)), pa.array(r["base"].values.to_numpy() - sizes * shift), pa.array(total), pa.array(10 ** np.minimum(-total / sizes, 300))],
                    names=["k", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

    schema = f"k {key_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return table.where("kind = 0").mapInArrow(run, schema).withColumnRenamed("k", key)
