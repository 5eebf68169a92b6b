"""Scans, sinks and resumable ingest exercised end to end on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.relational import read
from tessera.session import new_folder
from tessera.sources import tables
from tessera.streaming import ingest as stream

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


@query("SELECT row_number() OVER () - 1 AS row_index, (row_number() OVER () - 1 - 10) // 7 AS shard, n_nationkey FROM nation QUALIFY row_index >= 10 AND row_index < 24")
def row_range_shards(spark, sf_dir):
    return tables.row_ranges(spark, f"{sf_dir}/nation.parquet", 10, 24, 7).select("row_index", "shard", "n_nationkey")


@query("SELECT doc_id, lang, CASE WHEN doc_id % 2 = 1 THEN source END AS source FROM documents")
def union_by_name_scan(spark, sf_dir):
    d, root = read(spark, sf_dir, "documents"), new_folder(spark, "vintages")
    tables.write_table(d.where("doc_id % 2 = 0").select("doc_id", "lang"), f"{root}/old")
    tables.write_table(d.where("doc_id % 2 = 1").select("lang", "source", "doc_id"), f"{root}/new")
    return tables.read_by_name(spark, [f"{root}/old", f"{root}/new"]).select("doc_id", "lang", "source")


@query("SELECT part, count(*) AS \"rows\", min(doc_id) AS first, max(doc_id) AS last FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'b' END AS part FROM documents) GROUP BY 1")
def manifest_scan(spark, sf_dir):
    d, root = read(spark, sf_dir, "documents").select("doc_id"), new_folder(spark, "manifest")
    for part, rows in (("a", d.where("doc_id % 2 = 0")), ("b", d.where("doc_id % 2 = 1"))):
        tables.write_table(rows.withColumn("part", F.lit(part)), f"{root}/{part}")
    got = tables.read_parts(spark, root, ["a", "b"], "doc_id long, part string")
    return got.groupBy("part").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def resumable_ingest(spark, sf_dir):
    root = new_folder(spark, "ingest")
    e = read(spark, sf_dir, "events")
    e.where("event_id % 2 = 0").repartition(3).write.parquet(f"{root}/in")
    keep = lambda df: df.select("event_id", "event_type", "value")
    stream.ingest(spark, f"{root}/in", e.schema, f"{root}/out", f"{root}/check", keep, files_per_batch=2)
    e.where("event_id % 2 = 1").repartition(2).write.mode("append").parquet(f"{root}/in")
    stream.ingest(spark, f"{root}/in", e.schema, f"{root}/out", f"{root}/check", keep, files_per_batch=2)
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_by_signature(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents", "labels")
    return stream.pending(docs.select("doc_id"), labels.select("doc_id", F.lit("s1").alias("signature")), "doc_id", "s1")


@query("SELECT page_id, octet_length(encode(html)) AS body_bytes, sha256(html) AS body_sha256, CASE WHEN page_id % 4 = 1 THEN 'HASH_MISMATCH' END AS problem FROM pages")
def raw_record_scan(spark, sf_dir):
    from tessera.operators.intake import source_problem

    root = new_folder(spark, "raw")
    body = F.encode("html", "utf-8")
    digest = F.sha2(F.when(F.expr("page_id % 4 = 1"), F.lit("x")).otherwise(F.col("html")), 256)
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url", F.lit("SUCCESS_RAW").alias("status"), F.base64(body).alias("body_base64"), digest.alias("body_sha256"), F.octet_length("html").cast("long").alias("body_bytes"))
    pages.write.option("compression", "gzip").json(f"{root}/raw")
    got = tables.read_raw_records(spark, f"{root}/raw")
    problem = source_problem(F.col("status"), F.col("body_bytes"), F.col("body_sha256"), F.col("body"))
    return got.select(F.col("doc_id").alias("page_id"), F.octet_length("body").alias("body_bytes"), F.sha2("body", 256).alias("body_sha256"), problem.alias("problem"))
