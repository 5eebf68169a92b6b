"""Snapshot checks over documents without text give what their SQL gives."""

import duckdb
import pytest

from tessera.operators import spans as S
from tessera.plans import registry


@pytest.fixture(scope="module")
def blank_dir(tmp_path_factory):
    """The given documents, with texts emptied, made null and blank; identifiers that faults are sown by among them."""
    folder = tmp_path_factory.mktemp("blank")
    text = "CASE WHEN doc_id IN (11, 64, 75, 98) THEN '' WHEN doc_id IN (12, 125, 146, 195) THEN NULL WHEN doc_id = 13 THEN ' ' ELSE text END"
    duckdb.sql(f"COPY (SELECT * REPLACE ({text} AS text) FROM '/root/testdata/sf0.001/documents.parquet') TO '{folder}/documents.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", ["int01_snapshot_checks", "int01_missing_document_children", "int01_orphan_sections"])
def test_checks_of_texts_without_characters_equal_sql(spark, blank_dir, name):
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{blank_dir}/documents.parquet'")
        want = dict(db.sql(registry.oracle_sql()[name]).fetchall())
    assert {r["check"]: r.violations for r in registry.queries()[name](spark, blank_dir).collect()} == want


def test_a_span_of_none_is_sound_in_a_blank_text_alone(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "u", ""), (2, "u", "text")], "doc_id long, url string, source_text string").withColumn("source_text_sha256", F.sha2("source_text", 256))
    kids = S.windows(docs.withColumnRenamed("source_text", "text").select("doc_id", "text"), "doc_id", "text", 50, 40, blank=True)
    kids = kids.withColumns({"token_count": F.lit(1).cast("long"), "parent_id": F.lit("p"), "section_id": F.lit("s")})
    none = kids.where("doc_id = 2").withColumns({"end_char": F.lit(0), "text": F.lit("")})
    sections = docs.select("doc_id", F.lit("s").alias("section_id"), F.lit(0).alias("start_char"), F.length("source_text").alias("end_char"), "source_text_sha256")
    ids = docs.select("doc_id", "url")
    for blank, table, want in ((True, kids, 0), (False, kids, 1), (True, none, 1)):
        rows = {r["check"]: r.violations for r in S.integrity(docs, ids.where("false"), ids, table, kids, sections, blank=blank).collect()}
        assert rows["children_source_span_failure"] == want and rows["orphan_sections"] == int(not blank)
