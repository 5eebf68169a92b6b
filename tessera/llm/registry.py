"""The queries of the training-data operators and the pipeline, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import blocks, bpe, cotraining, interpolation, languages, repair, rotation, simhash, sstable, templates, url_trees, warc, whitening
from tessera.session import ship_package


def vocabulary_path() -> str:
    """The public word-level vocabulary that the contracts name."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return bpe.encode(docs, vocabulary_path(), outputs=("digests",))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash.groups(docs).select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return sstable.read_shards(sstable.write_shards(docs, vocabulary_path()), outputs=("crc32",))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return templates.contaminated(docs, items)


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return interpolation.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, model = languages.fit(docs.where(~languages.held_out()))
    found = languages.identify(docs, names, model)
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score", "languages", "proportions")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.read_archives(warc.write_archives(pages))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return cotraining.score(docs, cotraining.fit(docs, labels))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_main_text": op2_main_text,
    "op3_simhash": op3_simhash,
    "op4_token_shards": op4_token_shards,
    "op5_decontamination": op5_decontamination,
    "op6_language_model": op6_language_model,
    "op7_embeddings": op7_embeddings,
    "op8_languages": op8_languages,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
    "op11_conversations": op11_conversations,
    "op12_whitening": op12_whitening,
    "op13_url_filters": op13_url_filters,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op7_embeddings": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), l AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93
        ), r AS (
            SELECT vec_id AS x, vec_id AS y FROM embeddings
            UNION
            SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
        ), c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x), n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
        SELECT c.x AS vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, c.x = c.component_id AS kept
        FROM c LEFT JOIN n ON n.x = c.x
    """,
    "op9_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), w AS (
            SELECT payload_digest, payload_bytes, max(page_id) AS chosen FROM p WHERE payload_bytes >= 1000 GROUP BY ALL
        )
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN w.chosen IS NULL OR w.chosen = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN w.chosen <> p.page_id THEN w.chosen END AS refers_to
        FROM p LEFT JOIN w ON p.payload_digest = w.payload_digest AND p.payload_bytes = w.payload_bytes
    """,
    "op11_conversations": r"""
        WITH RECURSIVE bits(i, v, k) AS (
            SELECT range, range::UBIGINT, 0 FROM range(256)
            UNION ALL
            SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
        ), crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
        keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::UBIGINT) AS bytes
            FROM conversations
        ), hashed AS (
            SELECT conv_id, turn, role, text,
                   xor(list_reduce(list_concat([4294967295::UBIGINT], bytes), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::INTEGER + 1])), 4294967295::UBIGINT) % 20 AS harm
            FROM keyed, crc
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
            FROM hashed, (VALUES (1), (2)) c(copy) WHERE harm <> 0 AND (copy = 1 OR harm = 3)
        ), marked AS (
            SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS content, left(role, 1) AS initial,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos
            FROM damaged
        ), turns AS (
            SELECT *, CASE WHEN content = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(content, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair
            FROM marked
        ), ids AS (SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
        numbered AS (SELECT ids.c, t.pos, t.role, t.text, t.initial, t.fault FROM turns t JOIN ids ON t.conv_id IS NOT DISTINCT FROM ids.conv_id),
        inserted(q, r, price, letters, more) AS (
            VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
                   (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:'])
        ), edits(q, r, letter, initial, price) AS (
            VALUES (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0),
                   (0, 2, 'R', NULL, 1), (1, 2, 'R', NULL, 1), (3, 2, 'R', NULL, 1), (2, 3, 'R', NULL, 1), (0, 0, 'D', NULL, 2), (1, 1, 'D', NULL, 2), (2, 2, 'D', NULL, 2), (3, 3, 'D', NULL, 2)
        ), paths(c, pos, q, cost, audit, parts) AS (
            SELECT c, 0::BIGINT, 0, 0, '', []::VARCHAR[] FROM ids
            UNION ALL
            SELECT * FROM (
                SELECT p.c, n.pos, e.r, p.cost + i.price + e.price + CASE WHEN n.fault = 'truncated' AND e.letter <> 'D' THEN 5 ELSE 0 END AS total,
                       p.audit || i.letters || e.letter AS trail,
                       list_concat(p.parts, i.more, CASE e.letter WHEN 'D' THEN [] WHEN 'K' THEN [n.role || ':' || n.text] ELSE [CASE e.r WHEN 2 THEN 'user:' ELSE 'assistant:' END || n.text] END)
                FROM paths p JOIN numbered n ON n.c = p.c AND n.pos = p.pos + 1
                JOIN inserted i ON i.q = p.q JOIN edits e ON e.q = i.r AND (e.initial IS NULL OR e.initial = n.initial) AND (e.letter = 'D' OR n.fault NOT IN ('blank', 'duplicate'))
                QUALIFY row_number() OVER (PARTITION BY p.c, e.r ORDER BY total, trail) = 1
            )
        ), last AS (SELECT ids.c, ids.conv_id, count(n.pos) AS rows FROM ids LEFT JOIN numbered n ON n.c = ids.c GROUP BY ALL),
        done AS (
            SELECT l.conv_id, p.cost + i.price AS total, p.audit || i.letters AS trail, array_to_string(list_concat(p.parts, i.more), chr(10)) AS repaired
            FROM last l JOIN paths p ON p.c = l.c AND p.pos = l.rows JOIN inserted i ON i.q = p.q WHERE i.r IN (0, 3)
            QUALIFY row_number() OVER (PARTITION BY l.c ORDER BY total, trail) = 1
        ), counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM turns GROUP BY conv_id
        )
        SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, total::BIGINT AS cost, trail AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
        FROM done d LEFT JOIN counts k ON d.conv_id IS NOT DISTINCT FROM k.conv_id
    """,
}


def queries() -> dict:
    def shipped(f):
        def run(spark, sf_dir):
            ship_package(spark)
            return f(spark, sf_dir)

        return run

    return {k: shipped(f) for k, f in QUERIES.items()}


def oracle_sql() -> dict:
    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
