"""Manifest-listed tables, checked scans, row ranges and raw record shards."""

from __future__ import annotations

import json
import posixpath
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Raw crawl records, one JSON object a line.
RAW_RECORD = "doc_id long, url string, fetched_at string, status string, final_url string, http_status long, content_type string, body_base64 string, body_sha256 string, body_bytes long, elapsed_ms double, attempts long"


def confined(root: str, parts: list[str]) -> list[str]:
    """Paths of the parts below root; a part that leaves root is an error."""
    base, out = root.rstrip("/"), []
    for part in parts:
        path = posixpath.normpath(f"{base}/{part}") if "://" not in base else base + posixpath.normpath("/" + part)
        if part.startswith("/") or ".." in part.split("/"):
            raise ValueError(f"part outside its table: {part}")
        out.append(path)
    return out


def read_parts(spark: SparkSession, root: str, parts: list[str], schema: StructType | str | None = None, form: str = "parquet") -> DataFrame:
    """A table is the ordered list of its parts, never a pattern over a folder."""
    reader = spark.read.format(form)
    reader = reader.schema(schema) if schema is not None else reader
    return reader.load(confined(root, parts))


#: Bytes of a file that are held at once while it is hashed, and schemes of files that executors open by themselves.
PIECE, OPENED = 1 << 20, ("file",)


def hashed(spark: SparkSession, rows: list[tuple[str, str, str | None]]) -> DataFrame:
    """(name, expected, found) of rows (name, path, expected): the SHA-256 of each file, null for one that
    is missing, read in pieces, so that memory does not grow with the file. Files of the shared folder
    are hashed in tasks, one each; those of other file systems by the driver's Hadoop client, as
    Spark's own reader of binary files holds a file as one value."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def located(path):
        target = jvm.org.apache.hadoop.fs.Path(path)
        uri = target.getFileSystem(conf).makeQualified(target).toUri()
        return uri.getScheme(), uri.getPath()

    def streamed(path):
        target = jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(conf)
        if not system.exists(target):
            return None
        stream = system.open(target)
        try:
            return jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()

    near, far = [], []
    for name, path, expected in rows:
        scheme, plain = located(path)
        if scheme in OPENED:
            near.append((name, plain, expected))
        else:
            far.append((name, expected, path))
    with ThreadPoolExecutor(4) as pool:
        digests = list(pool.map(streamed, [path for *_, path in far]))
    piece = PIECE

    def read(batches):
        import hashlib

        import pyarrow as pa

        def digest(path):
            try:
                with open(path, "rb") as f:
                    h = hashlib.sha256()
                    while data := f.read(piece):
                        h.update(data)
                    return h.hexdigest()
            except FileNotFoundError:
                return None

        for batch in batches:
            names, paths, expected = batch.columns
            yield pa.RecordBatch.from_arrays([names, expected, pa.array([digest(p) for p in paths.to_pylist()], pa.string())], names=["name", "expected", "found"])

    schema = "name string, expected string, found string"
    local = spark.createDataFrame(near, "name string, path string, expected string").repartition(max(1, len(near)))
    return local.mapInArrow(read, schema).unionByName(spark.createDataFrame([(n, e, d) for (n, e, _), d in zip(far, digests, strict=True)], schema))


def damaged_parts(spark: SparkSession, root: str, digests: dict[str, str]) -> DataFrame:
    """(name, expected, found) of parts whose SHA-256 is not the manifest's."""
    paths = confined(root, list(digests))
    rows = hashed(spark, [(posixpath.basename(p), p, d) for p, d in zip(paths, digests.values(), strict=True)])
    return rows.where(~F.col("expected").eqNullSafe(F.col("found")))


def part_digests(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """SHA-256 of each file by name; paths may be patterns. One row a file reaches the driver."""
    jvm, rows = spark.sparkContext._jvm, []
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        met = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
        if not met:
            raise FileNotFoundError(path)
        rows += [(s.getPath().getName(), s.getPath().toString(), None) for s in met]
    return {r["name"]: r["found"] for r in hashed(spark, rows).collect()}


def read_checked(spark: SparkSession, root: str, digests: dict[str, str], schema: StructType | str | None = None) -> DataFrame:
    """read_parts after every part has met its checksum; a damaged or missing part is an error."""
    bad = [r["name"] for r in damaged_parts(spark, root, digests).collect()]
    if bad:
        raise ValueError(f"parts that differ from their manifest: {', '.join(sorted(bad))}")
    return read_parts(spark, root, list(digests), schema)


def publish_json(spark: SparkSession, path: str, value) -> None:
    """One JSON document, keys in order, whole or not at all: written aside and renamed."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(value, sort_keys=True, ensure_ascii=False).encode()))
    finally:
        stream.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"could not publish {path}")


def read_by_name(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of several vintages as one table: columns meet by name, missing ones are null."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def row_ranges(spark: SparkSession, path: str, start: int, stop: int, shard: int) -> DataFrame:
    """Rows start to stop of one file with their shard, by the reader's own row numbers."""
    df = spark.read.parquet(path).select("*", F.col("_metadata.row_index").alias("row_index"))
    return df.where((F.col("row_index") >= start) & (F.col("row_index") < stop)).withColumn("shard", F.floor((F.col("row_index") - start) / shard))


def read_raw_records(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Gzip JSON lines with the body decoded; damaged lines and bodies give nulls."""
    df = spark.read.schema(RAW_RECORD).json(paths)
    return df.withColumn("body", F.expr("try_to_binary(body_base64, 'base64')")).drop("body_base64")


def require_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """df itself if it has these columns of these types; else an error that names what is wrong."""
    have = dict(df.dtypes)
    wrong = {c: (have.get(c), k) for c, k in kinds.items() if have.get(c) != k}
    if wrong:
        raise ValueError(f"columns (found, wanted): {wrong}")
    return df


def expect_unique(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """df itself if key is unique and the number of rows is the expected one."""
    n, distinct = df.agg(F.count("*"), F.count_distinct(key)).first()
    if n != distinct or (rows is not None and n != rows):
        raise ValueError(f"{n} rows, {distinct} distinct {key}, expected {rows}")
    return df


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", row_group: int | None = None, records: int | None = None) -> None:
    """zstd Parquet; by default a table is written once and never over another."""
    w = df.write.mode(mode).option("compression", "zstd")
    w = w.option("parquet.block.size", row_group) if row_group else w
    w = w.option("maxRecordsPerFile", records) if records else w
    w.parquet(path)


def write_ordered_parts(df: DataFrame, path: str, order: str, then: str | None = None, parts: int | None = None) -> None:
    """Parts of contiguous, sorted ranges of `order`."""
    keys = [order] + ([then] if then else [])
    dealt = df.repartitionByRange(parts, order) if parts else df.repartitionByRange(order)
    write_table(dealt.sortWithinPartitions(*keys), path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def publish(df: DataFrame, path: str) -> None:
    """Write beside the destination and rename the whole folder last, by the file system's own
    client; a destination that exists is an error."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    draft = f"{path}.draft"
    write_table(df, draft, mode="overwrite")
    source, target = jvm.org.apache.hadoop.fs.Path(draft), jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target) or not fs.rename(source, target):
        raise FileExistsError(path)


def split_outputs(df: DataFrame, column: str, outputs: list[str], root: str) -> None:
    """Write the array fields of one struct column as tables of their own, from one computation:
    the struct is written once and read back for each table."""
    from tessera.session import materialise

    held = materialise(df.select(column), "outputs")
    for name in outputs:
        write_table(held.select(F.explode(f"{column}.{name}").alias("r")).select("r.*"), f"{root}/{name}")


def submission(predictions: DataFrame, query_key: str, doc: str, text: str) -> DataFrame:
    """(id, relevant_docs, relevant_chunks) of each query, ready for JSON lines, in `place` order."""
    chunks = F.array_sort(F.collect_list(F.struct("place", F.col(doc).alias("doc_id"), F.col(text).alias("chunk_text"))))
    rows = predictions.groupBy(F.col(query_key).alias("id")).agg(chunks.alias("c"))
    return rows.select("id", F.array_distinct(F.transform("c", lambda x: x["doc_id"])).alias("relevant_docs"), F.transform("c", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["chunk_text"].alias("chunk_text"))).alias("relevant_chunks"))
