"""Seekable archives, and the pipeline stage by stage."""

import hashlib
import io

import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import registry, templates, warc
from tessera.llm.files import opened

LONG = "x" * 1500


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as k", "'d' as digest", "0 as size")


def test_archives_round_trip(spark):
    rows = [(1, "http://a/", LONG), (7, None, LONG), (4, "http://a b/\r\nX: y", LONG), (2, "u", "short"), (3, "u", "short"), (5, "u", None), (6, "é", "é" * 600), (8, "u", "é" * 600), (9, "u", "WARC/1.1\r\n\r\n" * 200), (None, "u", LONG), (7, None, LONG), (10, "u", "<p>" * 2_000_000)]
    manifest = warc.write_archives(table(spark, rows))
    got = warc.read_archives(manifest, payload=True).collect()
    assert sorted(r.page_id or 0 for r in got) == sorted(k or 0 for k, _, _ in rows)
    html = {k: (h or "").encode() for k, _, h in rows}
    chosen = {1: 7, 4: 7, 6: 8, None: 7}
    for r in got:
        body = html[r.page_id]
        assert r.payload_bytes == len(body) and r.payload_digest == hashlib.sha1(body).hexdigest()
        assert r.refers_to == chosen.get(r.page_id) and r.record_type == ("revisit" if r.page_id in chosen else "response")
        assert (r.payload is None) == (r.record_type == "revisit") and (r.payload is None or bytes(r.payload) == body)
    assert warc.read_archives(warc.write_archives(table(spark, []))).count() == 0


def test_frames_stand_alone_and_records_are_found(monkeypatch, tmp_path):
    from tessera.llm.files import publishing

    monkeypatch.setattr(warc, "FRAME_BYTES", 3000)
    path = f"file://{tmp_path}/a.warc.zst"
    with publishing(path) as f:
        w = warc.BundleWriter(f)
        for k in (5, -2, 9, 1, 8):
            w.add(k, warc.record(k, "http://a/", (str(k) * 900).encode(), "d", None))
        w.finish()
    with opened(path) as f:
        b = warc.Bundle(f)
        assert sum(plain > 0 for _, _, plain in b.frames) > 1
        for k in (5, -2, 9, 1, 8):
            headers, block = b.find(k)
            assert headers["page-id"] == str(k) and block.endswith((str(k) * 900).encode())
        assert b.find(77) is None and len(list(b.records())) == 5
    raw = open(f"{tmp_path}/a.warc.zst", "rb").read()  # any Zstandard reader skips the tables
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain.count(b"WARC-Type: response") == 5


def test_stages_keep_columns_and_clean_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen = {r.doc_id for r in docs.collect()}
    at, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf_dir)
        assert at.columns == docs.columns
        at = spark.createDataFrame(at.collect(), docs.schema)
        kept[name] = {r.doc_id for r in at.collect()}
        assert kept[name] <= seen
        seen = kept[name]
    good = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    assert len(kept["language_id"] & good) == len(good)
    assert len(kept["quality"] & good) > 0.93 * len(good)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len({texts[i] for i in kept["near_dedup"]}) == len(kept["near_dedup"])
    left = docs.where(F.col("doc_id").isin(list(kept["decontamination"])))
    assert templates.contaminated(left, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, at, sf_dir)
    assert {r.doc_id for r in last.collect()} == kept["decontamination"]


def test_stages_of_odd_rows(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    schema = "doc_id long, text string, lang string, source string, n_chars long, k string, fp int"
    rows = [(1, None, "en", "s", 0, "a", 1), (2, "", None, None, None, None, None), (3, "some plain words that stand here", "en", "s", 33, "a", 1), (3, "some plain words that stand here", "en", "s", 33, "a", 1)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() <= len(rows)
            assert name == "encoding" or out.columns == docs.columns


def test_every_operator_is_registered_once():
    names = [int(k[2:].split("_")[0]) for k in registry.queries() if k.startswith("op")]
    assert sorted(names) == list(range(1, 14)) and "pipeline" in registry.queries()
    assert pa.__version__
