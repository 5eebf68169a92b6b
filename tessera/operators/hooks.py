"""Where models plug in: encoders, rerankers and analyzers, with model-free defaults.

An encoder has `encode(list of texts) -> matrix` of unit rows and a `name`; a reranker has
`score(list of queries, list of texts) -> numbers`; an analyzer is a function from a text to tokens.
They are shipped to the workers and called on batches, never on single rows.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.session import ship_package

_WORD = re.compile(r"[^\W_]+")


class HashingEncoder:
    """Unit vectors of signed word counts: a word's MD5 gives its place and its sign. A text without
    words is a zero vector, which matches nothing."""

    def __init__(self, dimension: int = 64):
        if not 0 < dimension <= 1 << 16:
            raise ValueError("the dimension must fit four hexadecimal digits")
        self.dimension, self.name = dimension, f"hashing-{dimension}"

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension))
        known: dict[str, tuple[int, int]] = {}
        for row, text in zip(out, texts, strict=True):
            for word in _WORD.findall(text.lower().replace("ß", "ss").replace("ς", "σ")):
                if word not in known:
                    digest = hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()
                    known[word] = int(digest[:4], 16) % self.dimension, -1 if digest[4] >= "8" else 1
                place, sign = known[word]
                row[place] += sign
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=out, where=norms > 0)


class OverlapReranker:
    """Share of the query's distinct words that the text has."""

    def score(self, queries: list[str], texts: list[str]) -> np.ndarray:
        words = lambda t: set(_WORD.findall(t.lower()))
        pairs = [(words(q), words(t)) for q, t in zip(queries, texts, strict=True)]
        return np.array([len(q & t) / len(q) if q else 0.0 for q, t in pairs])


def encode_texts(rows: DataFrame, key: str, text: str, encoder, cache: DataFrame | None = None, batch: int = 256) -> DataFrame:
    """(key, text_sha256, embedding) of every row; null texts are read as empty.

    Equal texts are encoded once, and those in `cache` (text_sha256, embedding) not at all. Within a
    task texts are taken by length, so that a batch pads little, and are put back in order. A vector
    that is not finite, or neither of unit length nor zero, is an error.
    """
    spark = rows.sparkSession
    ship_package(spark)
    hashed = rows.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__t")).withColumn("text_sha256", F.sha2("__t", 256))
    wanted = hashed.groupBy("text_sha256").agg(F.first("__t").alias("text"))
    if cache is not None:
        wanted = wanted.join(cache.select("text_sha256"), "text_sha256", "left_anti")

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            order = np.argsort([len(t) for t in texts], kind="stable")
            made = [np.asarray(encoder.encode([texts[i] for i in order[k : k + batch]]), np.float64) for k in range(0, len(order), batch)]
            vectors = np.concatenate(made)[np.argsort(order, kind="stable")] if made else np.zeros((0, 1))
            norms = np.linalg.norm(vectors, axis=1)
            if not (np.isfinite(norms) & ((np.abs(norms - 1) <= 1e-4) | (norms == 0))).all():
                raise ValueError(f"{encoder.name} gave a vector that is not of unit length")
            offsets = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
            yield pa.RecordBatch.from_arrays([b.column("text_sha256"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))], names=["text_sha256", "embedding"])

    vectors = wanted.mapInArrow(run, "text_sha256 string, embedding array<double>")
    if cache is not None:
        vectors = vectors.unionByName(cache.select("text_sha256", F.col("embedding").cast("array<double>").alias("embedding")))
    return hashed.drop("__t").join(vectors, "text_sha256").select(key, "text_sha256", "embedding")


def rerank(pairs: DataFrame, query_text: str, text: str, reranker, score: str = "model_score") -> DataFrame:
    """pairs with the reranker's score; a pair with a null text has a null score."""
    ship_package(pairs.sparkSession)

    def run(batches):
        for b in batches:
            q, t = b.column(query_text).to_pylist(), b.column(text).to_pylist()
            at = [i for i in range(len(q)) if q[i] is not None and t[i] is not None]
            out: list[float | None] = [None] * len(q)
            for i, s in zip(at, reranker.score([q[i] for i in at], [t[i] for i in at]), strict=True):
                out[i] = float(s)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], names=[*b.schema.names, score])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return pairs.mapInArrow(run, StructType([*pairs.schema.fields, StructField(score, DoubleType())]))


def analyze(rows: DataFrame, text: str, lang: str, analyzers: dict | None = None, tokens: str = "tokens") -> DataFrame:
    """rows with the tokens of their compatibility-composed text: the native ones, and after them
    those that the analyzer of the row's language adds."""
    ship_package(rows.sparkSession)
    analyzers = analyzers or {}

    @F.pandas_udf("string")
    def composed(t):
        return t.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    @F.pandas_udf("array<string>")
    def added(t, language):
        return (t.to_frame("t").assign(g=language)).apply(lambda r: list(analyzers[r.g](r.t)) if r.g in analyzers and r.t is not None else [], axis=1)

    out = rows.withColumn("__c", composed(F.col(text)))
    native: Column = F.coalesce(T.lexical_tokens(F.col("__c")), F.array().cast("array<string>"))
    extra = F.when(F.col(lang).isin(list(analyzers)), added(F.col("__c"), F.col(lang))).otherwise(F.array().cast("array<string>")) if analyzers else F.array().cast("array<string>")
    return out.withColumn(tokens, F.concat(native, extra)).drop("__c")
