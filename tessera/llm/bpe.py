"""Byte-pair encoding by a pair occurrence index, and decoding.

All distinct words of a slice of a partition lie in one symbol array. An index maps each adjacent
pair that has a merge to all its positions; active ranks wait in a heap and are applied in
ascending order, each to all its positions at once, and the lists of the pairs that appear or
vanish beside them are updated. That gives the same ids as merging word by word, because in the
vocabulary no merge can create a pair of a lower rank (checked when a vocabulary is loaded).

Defined results: a null or empty text has no ids and decodes to the empty string; repeated rows
are encoded each; columns beside the key and the text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.chunks import chunk_codes, listed, slices, spread
from tessera.session import ship_package

#: Words whose ids a worker keeps from slice to slice, at most.
CACHED_WORDS = 300_000
#: Bytes of text at once where decoded texts stand beside it.
SLICE = 6_000_000
#: Fixed: the white space of the vocabulary's patterns.
SPACE = r"\t-\r \x85\xa0  -     　"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [names[b] for b in range(256)]


class Vocabulary:
    """A word-level BPE vocabulary of the tokenizers library's file format, ready for numpy."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for k, v in (vocab | self.added).items():
            self.tokens[v] = k
        self.id_text = [str(i) for i in range(len(self.tokens))]
        symbols = byte_symbols()
        self.inner = np.array([vocab.get(s, -1) for s in symbols], np.int32)
        self.final = np.array([vocab.get(s + suffix, -1) for s in symbols], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.base = len(self.tokens)
        keys = self.left * self.base + self.right
        self.rank_of = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.rank_of]
        last_made = np.full(self.base, -1)
        last_made[self.made] = np.arange(len(pairs))
        if (np.maximum(last_made[self.left], last_made[self.right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge of this vocabulary uses a token that a later merge makes")
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern.replace(r"\s", SPACE) + r"|\n")
        self.library = Tokenizer.from_str(text)
        self.symbols, self.byte_of = symbols, {c: b for b, c in enumerate(symbols)}
        self.seen: set[str] = set()
        self.odd: set[str] = set()
        if any(not x or x.split() != [x] for x in self.added):
            raise ValueError("an added token of this vocabulary holds white space")
        self.forget()
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it has none."""
        key = a.astype(np.int64) * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the words, by the pair occurrence index."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[data]
        symbols[ends - 1] = self.final[data[ends - 1]]
        n = len(symbols)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1] = -1
        before[ends - lengths] = -1
        alive = symbols >= 0
        if not alive.all():  # a byte that the vocabulary lacks breaks its word
            raise ValueError("the vocabulary lacks a byte")
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray) -> None:
            r = self.ranks(symbols[positions], symbols[after[positions]])
            found = r >= 0
            positions, r = positions[found], r[found]
            if not len(r):
                return
            order = np.argsort(r, kind="stable")
            positions, r = positions[order], r[order]
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            for rank, part in zip(r[np.concatenate(([0], cuts))].tolist(), np.split(positions, cuts), strict=True):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(active, rank)

        note(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            parts = index.pop(rank)
            p = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            q = after[p]
            a, b = self.left[rank], self.right[rank]
            ok = alive[p] & (q >= 0) & (symbols[p] == a) & (symbols[q] == b)
            p, q = p[ok], q[ok]
            if a == b and len(p) > 1:  # in a run of overlapping pairs every second one holds
                starts = np.concatenate(([True], q[:-1] != p[1:]))
                place = np.arange(len(p)) - np.maximum.accumulate(np.where(starts, np.arange(len(p)), 0))
                p, q = p[place % 2 == 0], q[place % 2 == 0]
            if not len(p):
                continue
            then = after[q]
            symbols[p] = self.made[rank]
            alive[q] = False
            after[p] = then
            inside = then >= 0
            before[then[inside]] = p[inside]
            first = before[p]
            note(np.concatenate((p[inside], first[first >= 0])))
        ids = symbols[alive]
        return ids, np.concatenate(([0], np.cumsum(alive)))[np.concatenate(([0], ends))] if n else np.zeros(len(words) + 1, np.int64)

    def words(self, chunks: list[str]) -> list[str]:
        """The words of all chunks in order, with a line feed after each chunk.

        Characters on which the tables of this process and of the library may differ (they follow
        different versions of Unicode) are compared once, and their chunks are left to the
        library's own normaliser and splitter.
        """
        joined = "\n".join([*chunks, ""])
        if joined.isascii():
            return self.pattern.findall(joined.lower())
        for c in set(joined) - self.seen:
            self.seen.add(c)
            if c not in "\n\ud800" and not c.isascii() and self.split_library(f"a{c}a!{c}!1{c}1") != self.split(f"a{c}a!{c}!1{c}1"):
                self.odd.add(c)
        if self.odd.isdisjoint(joined):
            return self.pattern.findall(self.lower(joined))
        out = []
        for odd, run in itertools.groupby(chunks, lambda c: not self.odd.isdisjoint(c)):
            for c in run if odd else ():
                out += [*self.split_library(c), "\n"]
            out += [] if odd else self.pattern.findall(self.lower("\n".join([*run, ""])))
        return out

    @staticmethod
    def lower(text: str) -> str:
        """Composed and lower-cased character by character: a final sigma has no form of its own."""
        return (text if text.isascii() else unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")).lower()

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(self.lower(text))

    def split_library(self, text: str) -> list[str]:
        n = self.library
        return [bytes(map(self.byte_of.__getitem__, w)).decode("utf-8") for w, _ in n.pre_tokenizer.pre_tokenize_str(n.normalizer.normalize_str(text))]

    def merge_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the words by the library's own model."""
        run, names = self.library.model.tokenize, self.symbols
        rows = [[t.id for t in run(w if w.isascii() and w.isprintable() else "".join([names[b] for b in w.encode("utf-8")]))] for w in words]
        return np.fromiter(itertools.chain.from_iterable(rows), np.int32), np.cumsum([0, *map(len, rows)])

    def forget(self) -> None:
        """Start the store of known words anew, with the line feed that ends a chunk and the added tokens."""
        self.known = {"\n": 0} | {f"\n{x}": i for i, x in enumerate(self.added, 1)}
        self.known_ids = np.array(list(self.added.values()), np.int32)
        self.known_sizes = np.array([0, *[1] * len(self.added)], np.int64)

    def encode_flat(self, chunks: list[str], by_library: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the ids of all chunks end to end and how many each has; a chunk is free of
        ASCII white space.

        Ids of words met before are kept in a bounded store, which never changes a result. Words lie
        in it end to end, so that no object stands for a chunk or an id.
        """
        joined, splits = "\n".join(chunks), {}
        if any(x in joined for x in self.added):  # chunks with added tokens are taken apart there
            splits = {i: [x for x in self.special.split(c) if x] for i, c in enumerate(chunks) if self.special.search(c)}
            pieces = [p for i, c in enumerate(chunks) for p in ([("", x)[x not in self.added] for x in splits[i]] if i in splits else [c])]
            words, parts = [], iter([x for i, c in enumerate(chunks) for x in (splits[i] if i in splits else [c])])
            of_piece = np.repeat(np.arange(len(chunks)), [len(splits.get(i, "x")) for i in range(len(chunks))])
            for w in self.words(pieces):
                if w == "\n":
                    x = next(parts)
                    words += [f"\n{x}", w] if x in self.added else [w]
                else:
                    words.append(w)
        else:
            words = self.words(chunks)
        fresh = list(dict.fromkeys([w for w in words if w not in self.known]))
        if len(self.known) + len(fresh) > CACHED_WORDS:
            self.forget()
            fresh = list(dict.fromkeys([w for w in words if w not in self.known]))
        if fresh:
            ids, offsets = self.merge_library(fresh) if by_library else self.merge([w.encode("utf-8") for w in fresh])
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.known_ids = np.concatenate((self.known_ids, ids))
            self.known_sizes = np.concatenate((self.known_sizes, np.diff(offsets)))
        code = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        flat = self.known_ids[spread(self.known_sizes, np.cumsum(self.known_sizes) - self.known_sizes, code)]
        ends = np.cumsum(self.known_sizes[code])[code == 0]
        sizes = np.diff(ends, prepend=0)
        return flat, (np.bincount(of_piece, weights=sizes, minlength=len(chunks)).astype(np.int64) if splits else sizes)

    def encode_chunks(self, chunks: list[str], by_library: bool = False) -> list[tuple[int, ...]]:
        """The ids of each chunk as a tuple."""
        flat, sizes = self.encode_flat(chunks, by_library)
        ids, ends = flat.tolist(), np.cumsum(sizes).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def decode(self, ids) -> str:
        """The vocabulary names no decoder: its tokens, joined by one space."""
        return " ".join(map(self.tokens.__getitem__, ids))


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    if shared.id not in _LOADED:
        _LOADED.clear()
        _LOADED[shared.id] = Vocabulary(shared.value)
    return _LOADED[shared.id]


class _Shared:
    """A broadcast text with the key under which a worker keeps what it built from it."""

    def __init__(self, broadcast, key: str):
        self.broadcast, self.id = broadcast, key

    @property
    def value(self):
        return self.broadcast.value


def share(spark, path: str) -> _Shared:
    """The vocabulary file of fixed size, broadcast; read where the driver runs."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return _Shared(spark.sparkContext.broadcast(text), hashlib.sha256(text.encode()).hexdigest())


def encode(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", outputs=("ids", "decoded")) -> DataFrame:
    """Encode every whole text and decode it again.

    Returns key and n_tokens, then for each of `outputs`: "ids" array<int>; "decoded" string;
    "digests" ids_sha256 and decoded_sha256, of the decimal ids joined by one space and of the
    decoded text in UTF-8. Nothing is shuffled.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = share(spark, vocabulary_path)
    kinds = {"ids": [("ids", "array<int>", pa.list_(pa.int32()))], "decoded": [("decoded", "string", pa.string())], "digests": [("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]}
    columns = [c for o in outputs for c in kinds[o]]
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = source.schema["key"].dataType.simpleString()

    def run(batches):
        v = _vocabulary(shared)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                offsets, chunks, codes = chunk_codes(part.column("text"))
                flat, counts = v.encode_flat(listed(chunks))
                ids, ends = flat.tolist(), np.cumsum(counts).tolist()
                ids = [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                if (counts == 0).any():
                    keep = counts[codes] > 0
                    offsets, codes = np.concatenate(([0], np.cumsum(keep)))[offsets], codes[keep]
                n = np.concatenate(([0], np.cumsum(counts[codes])))[offsets]
                made = {"n_tokens": pa.array(np.diff(n), pa.int64())}
                rows = [codes[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                if "ids" in outputs:
                    made["ids"] = pa.array([[x for c in r.tolist() for x in ids[c]] for r in rows], pa.list_(pa.int32()))
                if "decoded" in outputs or "digests" in outputs:
                    texts = np.array([v.decode(x) for x in ids] + [None], object)
                    decoded = [" ".join(texts[r].tolist()) for r in rows]
                if "decoded" in outputs:
                    made["decoded"] = pa.array(decoded, pa.string())
                if "digests" in outputs:
                    texts = np.array([" ".join(map(v.id_text.__getitem__, x)) for x in ids] + [None], object)
                    made["ids_sha256"] = pa.array([hashlib.sha256(" ".join(texts[r].tolist()).encode()).hexdigest() for r in rows], pa.string())
                    made["decoded_sha256"] = pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string())
                names = ["n_tokens", *[c[0] for c in columns]]
                yield pa.RecordBatch.from_arrays([part.column("key"), *[made[c] for c in names]], names=["key", *names])
        v.forget()  # the worker serves other stages after this one

    schema = ", ".join([f"`key` {key_type}", "n_tokens long", *[f"{c[0]} {c[1]}" for c in columns]])
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


def decode_ids(ids: DataFrame, vocabulary_path: str, column: str = "ids") -> DataFrame:
    """Add `decoded`, the text of the ids in `column`; a null list decodes to the empty string."""
    spark = ids.sparkSession
    ship_package(spark)
    shared = share(spark, vocabulary_path)

    @F.pandas_udf("string")
    def text(series):
        v = _vocabulary(shared)
        return series.map(lambda x: "" if x is None else v.decode(x))

    return ids.withColumn("decoded", text(F.col(column)))
