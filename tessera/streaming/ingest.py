"""Resumable ingest: each run takes the shards that no run has committed, and then stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest(spark: SparkSession, source: str, schema, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], files_per_batch: int = 64, batches_at_once: int | None = None) -> None:
    """Append transform(new files of source) to target as Parquet, batch by batch, until no file is
    left. The checkpoint holds which files are done; a batch that failed is repeated, and its own
    folder is overwritten, so no row is written twice."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/batch={number}")

    run = reader.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()


def pending(items: DataFrame, done: DataFrame, key: str, signature: str) -> DataFrame:
    """Items that no record of the same policy signature has finished. A finished item of another
    signature is a conflict: a changed policy needs a run of its own."""
    mine = done.where(F.col("signature") == signature)
    other = done.where(F.col("signature") != signature)
    if not other.isEmpty():
        raise ValueError("records of another policy: start a new run")
    return items.join(mine.select(key).distinct(), key, "left_anti")


def done_shards(parts: DataFrame, signature: str) -> DataFrame:
    """Shards whose marker is complete and bears the signature."""
    return parts.where((F.col("state") == "COMPLETE") & (F.col("signature") == signature)).select("shard").distinct()
