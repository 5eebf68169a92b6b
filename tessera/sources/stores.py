"""Stores that grow by what is new: vectors by the hash of their text, and representatives by content.

Both keep immutable files and a versioned manifest. A run writes its files first and commits last, so an
interrupted run leaves the store as it was, and a repeated one does its work once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import hooks
from tessera.session import materialise
from tessera.sources.manifests import Manifest


class VectorStore:
    """Vectors of texts under the SHA-256 of the text, in append-only blocks of one folder a hash prefix.
    Prefixes are key ranges: a lookup reads those its hashes fall in."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.manifest = spark, Manifest(spark, folder)
        self.version, self.state = self.manifest.load()
        if self.state is None:
            raise FileNotFoundError(folder)

    @classmethod
    def create(cls, spark: SparkSession, folder: str, encoder: str, prefix: int = 1) -> VectorStore:
        """An empty store of one encoder's vectors; `prefix` hexadecimal digits name a key range."""
        Manifest(spark, folder).commit(0, {"encoder": encoder, "prefix": prefix, "blocks": []})
        return cls(spark, folder)

    def vectors(self) -> DataFrame:
        """(text_sha256, embedding, prefix) of all blocks."""
        paths = [f"{self.manifest.folder}/{b['name']}" for b in self.state["blocks"]]
        schema = "text_sha256 string, embedding array<double>, prefix string"
        if not paths:
            return self.spark.createDataFrame([], schema)
        parts = [self.spark.read.schema(schema).parquet(p) for p in paths]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _prefix(self, sha: Column) -> Column:
        return F.substring(sha, 1, self.state["prefix"])

    def _append(self, vectors: DataFrame, blocks: list) -> int:
        """Write a block, commit it after `blocks` and give its rows; an empty one is not kept."""
        name = f"block-{uuid.uuid4().hex}"
        path = f"{self.manifest.folder}/{name}"
        rows = vectors.select("text_sha256", "embedding", self._prefix(F.col("text_sha256")).alias("prefix"))
        rows.repartition("prefix").sortWithinPartitions("prefix", "text_sha256").write.partitionBy("prefix").option("compression", "zstd").parquet(path)
        n = self.spark.read.schema("text_sha256 string, prefix string").parquet(path).count()
        if n or blocks != self.state["blocks"]:
            state = self.state | {"blocks": [*blocks, *([{"name": name, "rows": n}] if n else [])]}
            self.version, self.state = self.manifest.commit(self.version, state), state
        return n

    def add(self, rows: DataFrame, key: str, text: str, encoder) -> int:
        """Encode the texts that the store lacks, each once, and give their number."""
        if encoder.name != self.state["encoder"]:
            raise ValueError(f"a store of {self.state['encoder']} vectors takes none of {encoder.name}")
        texts = rows.select(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_sha256"), F.col(text).alias("text"))
        fresh = texts.groupBy("text_sha256").agg(F.first("text").alias("text")).join(self.vectors().select("text_sha256"), "text_sha256", "left_anti")
        return self._append(hooks.encode_texts(fresh.withColumnRenamed("text_sha256", "k"), "k", "text", encoder), self.state["blocks"])

    def lookup(self, rows: DataFrame, key: str, text: str) -> DataFrame:
        """(key, text_sha256, embedding) of every row; null where the store has none. The join is on prefix and
        hash, so key ranges that no row asks for are not read."""
        asked = rows.select(F.col(key), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_sha256")).withColumn("prefix", self._prefix(F.col("text_sha256")))
        return asked.join(self.vectors(), ["prefix", "text_sha256"], "left").select(key, "text_sha256", "embedding")

    def compact(self) -> None:
        """All blocks as one. The old files stay for readers of older versions."""
        if len(self.state["blocks"]) > 1:
            self._append(self.vectors(), [])


class Representatives:
    """For each content hash the row of the least key, kept in buckets of the hash. A delta rewrites the
    buckets that it touches and no others."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.manifest = spark, Manifest(spark, folder)
        self.version, self.state = self.manifest.load()
        if self.state is None:
            raise FileNotFoundError(folder)

    @classmethod
    def create(cls, spark: SparkSession, folder: str, schema: str, buckets: int = 64) -> Representatives:
        """schema: the columns of a row, key first; a bucket is a residue of the first 8 digits of the hash."""
        Manifest(spark, folder).commit(0, {"schema": schema, "buckets": buckets, "files": {}, "batch": -1, "cursor": None})
        return cls(spark, folder)

    def _read(self, buckets=None) -> DataFrame:
        schema = f"content_hash string, aliases long, {self.state['schema']}"
        paths = [f"{self.manifest.folder}/{p}" for b, p in sorted(self.state["files"].items()) if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def table(self) -> DataFrame:
        """(content_hash, aliases: rows that had it, the representative's columns)."""
        return self._read()

    def tail(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is above the greatest that any delta had: what a resumed run has to stage."""
        key = rows.columns[0]
        return rows if self.state["cursor"] is None else rows.where(F.col(key) > self.state["cursor"])

    def merge(self, delta: DataFrame, content: str, batch: int) -> bool:
        """Merge rows of the store's columns and `content`, the column that is hashed, as delta number `batch`; a
        number that was committed before is passed over, so a repeated batch changes nothing. The key is a
        long; rows of null content have no representative."""
        if batch <= self.state["batch"]:
            return False
        names = [c for c in delta.columns if c != content]
        key, n = names[0], self.state["buckets"]
        bucket = F.pmod(F.conv(F.substring("content_hash", 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")
        best = F.min(F.struct(*names)).alias("r")  # key first: the row of the least key
        fresh = delta.select(F.sha2(F.col(content), 256).alias("content_hash"), F.struct(*names).alias("r")).where("content_hash IS NOT NULL")
        fresh = fresh.groupBy("content_hash").agg(F.count("*").alias("aliases"), F.min("r").alias("r")).select("content_hash", "aliases", "r.*").withColumn("bucket", bucket)
        fresh = materialise(fresh, "delta")
        touched = {r.bucket for r in fresh.select("bucket").distinct().collect()}  # at most `buckets`
        greatest = delta.agg(F.max(key)).first()[0]
        both = fresh.unionByName(self._read(touched).withColumn("bucket", bucket))
        merged = both.groupBy("content_hash", "bucket").agg(F.sum("aliases").alias("aliases"), best).select("content_hash", "aliases", "r.*", "bucket")
        name = f"delta-{uuid.uuid4().hex}"
        if touched:
            merged.repartition("bucket").sortWithinPartitions("bucket", "content_hash").write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.manifest.folder}/{name}")
        seen = [c for c in (greatest, self.state["cursor"]) if c is not None]
        state = self.state | {"files": self.state["files"] | {str(b): f"{name}/bucket={b}" for b in touched}, "batch": batch, "cursor": max(seen, default=None)}
        self.version, self.state = self.manifest.commit(self.version, state), state
        return True


def follow(spark: SparkSession, source: str, schema, folder: str, checkpoint: str, rows, content: str, files_per_batch: int = 16) -> None:
    """Merge every file of `source` that no run has merged into the representatives of `folder`, batch by
    batch, and stop. rows(batch) gives the store's columns and `content`, the column that is hashed. The
    stream's batch number is the delta's, so a batch that failed between its commit and the checkpoint's
    is not merged twice."""

    def merge(batch: DataFrame, number: int) -> None:
        Representatives(spark, folder).merge(rows(batch), content, number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
