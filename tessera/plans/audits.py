"""Queries of audits: exclusion, retained crawls, evaluation by slices and ablations of fused legs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import audits as A
from tessera.operators import evaluation as E
from tessera.operators import ranking as K
from tessera.operators import retrieval as R
from tessera.plans.advanced import gold_passages
from tessera.plans.extended import HYBRID, TWO_LEGS, _two_legs
from tessera.plans.relational import read
from tessera.plans.retrieval import ALL_TERMS, _words, bm25_sql
from tessera.plans.textual import TITLES, TITLE_SQL
from tessera.session import materialise

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _table(rows, columns: dict[str, str], where: str = "true"):
    """A table of expressions that Spark and DuckDB read alike."""
    return rows.where(where).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def _table_sql(source: str, columns: dict[str, str], where: str = "true") -> str:
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source} WHERE {where}"


PAGE = {"doc_id": "doc_id", "url": "concat('https://e.org/a/', doc_id)", "final_url": "CASE WHEN doc_id % 13 = 0 THEN 'https://e.org/' WHEN doc_id % 13 = 1 THEN 'https://e.org/?id=1' ELSE concat('https://e.org/b/', doc_id) END"}


@query(rf"""WITH d AS (SELECT p.*, {TITLE_SQL}[d.doc_id % 9 + 1] AS title, CASE WHEN d.doc_id % 4 = 0 THEN replace(text, ' ', '') || sha256(text) || upper(sha256(text)) || sha256(text) ELSE text END AS text FROM documents d JOIN ({_table_sql('documents', PAGE)}) p USING (doc_id)),
    h AS (SELECT *, CASE WHEN trim(title) <> '' THEN trim(title) ELSE split_part(trim(text), chr(10), 1) END AS head, regexp_extract_all(text, '[A-Za-z0-9+/]{{180,}}={{0,2}}') AS runs FROM d)
    SELECT doc_id, CASE WHEN len(list_filter(runs, lambda v: length(v) - length(regexp_replace(v, '[a-z]', '', 'g')) >= 6 AND length(v) - length(regexp_replace(v, '[A-Z]', '', 'g')) >= 6 AND length(v) - length(regexp_replace(v, '[0-9]', '', 'g')) >= 4 AND len(list_distinct(string_split(rtrim(v, '='), ''))) >= 30)) > 0 THEN 'ENCODED_PAYLOAD_REVIEW'
    WHEN final_url = 'https://e.org/' THEN 'ARTICLE_REDIRECTED_TO_HOMEPAGE'
    WHEN NOT regexp_matches(head, '{T.ERROR_TITLE}') THEN NULL
    WHEN contains(lower(head), 'javascript') THEN 'JS_REQUIRED' WHEN contains(lower(head), 'sign in') THEN 'LOGIN_REQUIRED' WHEN contains(lower(head), '404') OR contains(lower(head), 'not found') THEN 'NOT_FOUND_PAGE' WHEN contains(lower(head), 'access denied') OR contains(lower(head), '403') THEN 'ACCESS_DENIED_PAGE' ELSE 'BOT_CHALLENGE' END AS exclusion_reason FROM h""")
def document_exclusions(spark, sf_dir):
    """Every document with a payload, a redirect and an error title sown by identifier."""
    d = read(spark, sf_dir, "documents")
    h = F.sha2("text", 256)
    body = F.when(F.expr("doc_id % 4 = 0"), F.concat(F.replace("text", F.lit(" "), F.lit("")), h, F.upper(h), h)).otherwise(F.col("text"))
    title = F.element_at(F.array(*[F.lit(t) for t in TITLES]), (F.col("doc_id") % 9 + 1).cast("int"))
    rows = d.select("doc_id", title.alias("title"), body.alias("text"), *[F.expr(e).alias(c) for c, e in PAGE.items() if c != "doc_id"])
    return rows.select("doc_id", A.exclusion_reason(F.col("title"), F.col("text"), F.col("url"), F.col("final_url")).alias("exclusion_reason"))


# A retained crawl of documents: two neighbours share a page, and each fault is sown by identifier.
URL = "concat('https://e.org/', doc_id - doc_id % 2, CASE WHEN doc_id % 2 = 1 THEN '#b' ELSE '' END)"
PAGE_URL = "concat('https://e.org/', CASE WHEN doc_id % 46 = 6 THEN 0 ELSE doc_id END)"
DIGEST = {"spark": "sha2(text, 256)", "duck": "sha256(text)"}
MAPPING = {"doc_id": "doc_id", "crawl_url_id": "doc_id - doc_id % 2", "original_url": URL}
OFFICIAL = {"id": "doc_id", "url": f"CASE WHEN doc_id % 29 = 2 THEN 'x' ELSE {URL} END"}
EXISTING = {"doc_id": "doc_id", "url": f"CASE WHEN doc_id % 15 = 0 THEN 'old' ELSE {URL} END"}
EXTRACTED = {"crawl_url_id": "crawl_url_id", "snapshot_id": "original_snapshot_id", "raw_sha256": "CASE WHEN crawl_url_id % 82 = 10 THEN 'x' ELSE raw_sha256 END", "extract_status": "extract_status", "text": "CASE WHEN crawl_url_id % 86 = 12 THEN '  ' ELSE text END", "char_count": "length(text) + CASE WHEN crawl_url_id % 90 = 14 THEN 1 ELSE 0 END"}


def _raw(kind: str) -> dict[str, str]:
    sha = DIGEST[kind]
    slash = r"'raw/a\\b'" if kind == "spark" else r"'raw/a\b'"
    return {
        "crawl_url_id": "doc_id",
        "fetch_url": PAGE_URL,
        "raw_path": f"CASE doc_id % 50 WHEN 0 THEN 'raw/../x' WHEN 2 THEN NULL WHEN 4 THEN 'RAW/x' WHEN 6 THEN {slash} ELSE concat('raw/', doc_id) END",
        "raw_sha256": f"CASE WHEN doc_id % 58 = 8 THEN upper({sha}) ELSE {sha} END",
        "raw_size_bytes": "CASE WHEN doc_id % 62 = 10 THEN 0 ELSE length(text) END",
        "original_crawl_record_json": f"""CASE WHEN doc_id % 70 = 12 THEN '{{"status":' ELSE concat('{{"status":"', CASE WHEN doc_id % 74 = 14 THEN 'FAILED' ELSE 'SUCCESS_RAW' END, '","snapshot_id":"s1","raw_sha256":"', {sha}, '","fetch_url":"', {PAGE_URL}, '"}}') END""",
        "original_snapshot_id": "CASE WHEN doc_id % 82 = 16 THEN 's0' ELSE 's1' END",
        "new_snapshot_id": "'s2'",
        "extract_status": "CASE WHEN doc_id % 10 = 8 THEN 'FAILED' ELSE 'EXTRACT_SUCCESS' END",
        "text": "text",
    }


RAW_ROWS, RAW_AGAIN, MAPPED, MAPPED_AGAIN = "doc_id % 2 = 0 AND doc_id % 34 <> 4", "doc_id % 94 = 18", "doc_id % 31 <> 1 AND doc_id % 38 > 1", "doc_id % 97 = 3"
DONE, DONE_AGAIN = "extract_status = 'EXTRACT_SUCCESS' AND crawl_url_id % 94 <> 20", "crawl_url_id % 106 = 22"
RETAINED = f"""mapping AS ({_table_sql('documents', MAPPING, MAPPED)} UNION ALL {_table_sql('documents', MAPPING, MAPPED_AGAIN)}), official AS ({_table_sql('documents', OFFICIAL)}), existing AS ({_table_sql('documents', EXISTING, 'doc_id % 5 = 0')}),
    raw AS ({_table_sql('documents', _raw('duck'), RAW_ROWS)} UNION ALL {_table_sql('documents', _raw('duck'), RAW_AGAIN)}), ex AS ({_table_sql('raw', EXTRACTED, DONE)} UNION ALL {_table_sql('raw', EXTRACTED, DONE_AGAIN)})"""


def _retained(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    mapping = _table(d, MAPPING, MAPPED).unionByName(_table(d, MAPPING, MAPPED_AGAIN))
    raw = _table(d, _raw("spark"), RAW_ROWS).unionByName(_table(d, _raw("spark"), RAW_AGAIN))
    done = _table(raw, EXTRACTED, DONE).unionByName(_table(raw, EXTRACTED, DONE_AGAIN))
    return mapping, raw, _table(d, OFFICIAL), _table(d, EXISTING, "doc_id % 5 = 0"), done


@query(rf"""WITH {RETAINED}, f AS (SELECT split_part(trim(url), '#', 1) AS fetched, id, url FROM official), x("check", violations) AS (
    SELECT 'duplicate_mapping_id', (SELECT count(*) - count(DISTINCT doc_id) FROM mapping) UNION ALL
    SELECT 'duplicate_raw_id', (SELECT count(*) - count(DISTINCT crawl_url_id) FROM raw) UNION ALL
    SELECT 'unmapped_native_id', (SELECT count(*) FROM mapping WHERE (doc_id, original_url) NOT IN (SELECT (id, url) FROM official)) UNION ALL
    SELECT 'mapping_missing_raw', (SELECT count(*) FROM mapping WHERE crawl_url_id NOT IN (SELECT crawl_url_id FROM raw)) UNION ALL
    SELECT 'raw_outside_mapping', (SELECT count(*) FROM raw WHERE crawl_url_id NOT IN (SELECT crawl_url_id FROM mapping)) UNION ALL
    SELECT 'native_url_conflict', (SELECT count(*) FROM mapping m, existing e WHERE m.doc_id = e.doc_id AND m.original_url <> e.url) UNION ALL
    SELECT 'fetch_url_mismatch', (SELECT count(*) FROM mapping m, raw r WHERE m.crawl_url_id = r.crawl_url_id AND split_part(m.original_url, '#', 1) <> r.fetch_url) UNION ALL
    SELECT 'invalid_raw_locator', (SELECT count(*) FROM raw WHERE NOT coalesce(regexp_matches(raw_path, '^raw/') AND strpos(raw_path, '..') = 0 AND strpos(raw_path, chr(92)) = 0, false)) UNION ALL
    SELECT 'invalid_raw_metadata', (SELECT count(*) FROM raw WHERE NOT coalesce(regexp_full_match(raw_sha256, '[0-9a-f]+') AND length(raw_sha256) = 64 AND raw_size_bytes > 0, false)) UNION ALL
    SELECT 'invalid_original_crawl', (SELECT count(*) FROM raw WHERE NOT coalesce(CASE WHEN json_valid(original_crawl_record_json) THEN original_crawl_record_json ->> '$.status' = 'SUCCESS_RAW' AND original_crawl_record_json ->> '$.snapshot_id' = original_snapshot_id AND original_crawl_record_json ->> '$.raw_sha256' = raw_sha256 AND original_crawl_record_json ->> '$.fetch_url' = fetch_url END, false)) UNION ALL
    SELECT 'snapshot_mismatch', (SELECT count(*) FROM raw WHERE original_snapshot_id <> 's1' OR new_snapshot_id <> 's2') UNION ALL
    SELECT 'missing_official_alias', (SELECT count(*) FROM f JOIN raw ON fetched = fetch_url WHERE (id, url) NOT IN (SELECT (doc_id, original_url) FROM mapping)) UNION ALL
    SELECT 'duplicate_extraction', (SELECT count(*) - count(DISTINCT crawl_url_id) FROM ex) UNION ALL
    SELECT 'extraction_binding', (SELECT count(*) FROM ex e LEFT JOIN raw r USING (crawl_url_id) WHERE NOT coalesce(e.extract_status = 'EXTRACT_SUCCESS' AND r.extract_status = e.extract_status AND r.raw_sha256 = e.raw_sha256 AND r.original_snapshot_id = e.snapshot_id, false)) UNION ALL
    SELECT 'missing_successful_extraction', (SELECT count(*) FROM raw WHERE extract_status = 'EXTRACT_SUCCESS' AND crawl_url_id NOT IN (SELECT crawl_url_id FROM ex)) UNION ALL
    SELECT 'invalid_source_length', (SELECT count(*) FROM ex WHERE NOT coalesce(trim(text) <> '' AND char_count = length(text), false)))
    SELECT "check", violations::BIGINT AS violations FROM x""")
def retained_checks(spark, sf_dir):
    """The sixteen checks of a retained crawl and its extraction."""
    mapping, raw, official, existing, done = _retained(spark, sf_dir)
    return A.retained_crawl(mapping, raw, official, existing, "s2", "s1").unionByName(A.retained_extraction(raw, done))


GOLD = "gold AS (SELECT item_id, doc_id, lang FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE b.text <> '')"
JUDGED = """m AS (SELECT g.item_id, coalesce(h.hits / h.np, 0) AS precision, coalesce(h.hits, 0) / g.ng AS recall FROM (SELECT item_id, count(DISTINCT doc_id) AS ng FROM gold GROUP BY 1) g LEFT JOIN (SELECT p.item_id, count(*) AS np, count(o.doc_id) AS hits FROM p LEFT JOIN (SELECT DISTINCT item_id, doc_id FROM gold) o USING (item_id, doc_id) GROUP BY 1) h USING (item_id)),
    e AS (SELECT *, CASE WHEN precision + recall > 0 THEN 5 * precision * recall / (4 * precision + recall) ELSE 0 END AS f2 FROM m),
    s AS (SELECT DISTINCT item_id, 'language' AS slice, coalesce(lang, 'unknown') AS value FROM gold UNION ALL SELECT item_id, 'complexity', CASE WHEN length(text) >= 120 AND regexp_matches(text, '(?i)[,;:]|\\b(?:and|or|with|without|und|et|y|con)\\b') THEN 'complex' ELSE 'simple' END FROM benchmark)"""
TOP = f"{ALL_TERMS}, {bm25_sql('b', 'documents', 'doc_id', 'text')}, r AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM b)"
SLICES = "SELECT slice, value, count(*) AS queries, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f2), 6) AS f2 FROM e JOIN s USING (item_id) GROUP BY ALL"


def _gold_and_slices(spark, sf_dir):
    gold = materialise(gold_passages(spark, sf_dir, "lang").select("item_id", "doc_id", "lang"), "gold")
    items = read(spark, sf_dir, "benchmark")
    language = gold.select("item_id", F.lit("language").alias("slice"), F.coalesce("lang", F.lit("unknown")).alias("value"))
    kind = F.when(K.is_complex(F.col("text")), "complex").otherwise("simple")
    return gold.drop("lang"), language.unionByName(items.select("item_id", F.lit("complexity").alias("slice"), kind.alias("value")))


def _ranking(spark, sf_dir):
    docs, items = read(spark, sf_dir, "documents", "benchmark")
    return R.bm25_topk(items, "item_id", _words(), docs, ["doc_id"], {"text": (_words(), 1.0)}, 5)


@query(f"WITH {GOLD}, {TOP}, p AS (SELECT item_id, doc_id FROM r WHERE rank <= 5), {JUDGED} {SLICES}")
def metrics_by_slice(spark, sf_dir):
    """Document metrics of the first five of every item, by language of its gold and by complexity."""
    gold, slices = _gold_and_slices(spark, sf_dir)
    return A.sliced(E.document_metrics(_ranking(spark, sf_dir), gold, "item_id", "doc_id"), slices, "item_id")


@query(f"""WITH {GOLD}, {TOP}, p AS (SELECT item_id, doc_id FROM r WHERE rank <= 1), {JUDGED}, before AS ({SLICES}), after AS (WITH p AS (SELECT item_id, doc_id FROM r WHERE rank <= 5), {JUDGED} {SLICES})
    SELECT slice, value, round(a.f2 - b.f2, 6) AS change, coalesce(round(a.f2 - b.f2, 6) >= -0.01, false) AS passed FROM before b FULL JOIN after a USING (slice, value)""")
def slice_regression_gate(spark, sf_dir):
    """Whether keeping five documents an item instead of one makes any slice worse by more than 0.01."""
    gold, slices = _gold_and_slices(spark, sf_dir)
    ranking = _ranking(spark, sf_dir)
    of = lambda rows: A.sliced(E.document_metrics(rows, gold, "item_id", "doc_id"), slices, "item_id")
    return A.slice_gate(of(ranking.where("rank = 1")), of(ranking), 0.01)


VARIANTS = {"full": TWO_LEGS, "dense_only": {"dense": 1.0}} | {f"without_{b}": {o: w for o, w in TWO_LEGS.items() if o != b} for b in TWO_LEGS}
GRID_SQL = ", ".join(f"('{v}', '{b}', {w}::DOUBLE)" for v, ws in VARIANTS.items() for b, w in ws.items())


@query(f"""WITH {GOLD}, {HYBRID}, grid(variant, branch, weight) AS (VALUES {GRID_SQL}), fu AS (SELECT variant, item_id, doc_id, round(sum(weight / (60 + rank)), 6) AS score FROM legs JOIN grid USING (branch) GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY variant, item_id ORDER BY score DESC, doc_id) AS place FROM fu QUALIFY place <= 5), o AS (SELECT DISTINCT item_id, doc_id FROM gold),
    h AS (SELECT variant, item_id, count(*) AS np, count(o.doc_id) AS hits FROM k LEFT JOIN o USING (item_id, doc_id) GROUP BY ALL), g AS (SELECT v.variant, item_id, count(*) AS ng FROM o, (SELECT DISTINCT variant FROM grid) v GROUP BY ALL),
    m AS (SELECT variant, coalesce(hits / np, 0) AS precision, coalesce(hits, 0) / ng AS recall FROM g LEFT JOIN h USING (variant, item_id)), e AS (SELECT *, CASE WHEN precision + recall > 0 THEN 5 * precision * recall / (4 * precision + recall) ELSE 0 END AS f2 FROM m),
    a AS (SELECT variant, count(*) AS queries, avg(precision) AS precision, avg(recall) AS recall, avg(f2) AS f2 FROM e GROUP BY 1)
    SELECT variant, queries, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f2, 6) AS f2, round(f2 - (SELECT f2 FROM a WHERE variant = 'full'), 6) AS change FROM a""")
def leg_ablations(spark, sf_dir):
    """The fused legs of hybrid_candidates with each leg left out in turn, judged on the items' gold."""
    gold = materialise(gold_passages(spark, sf_dir).select("item_id", "doc_id"), "gold")
    return A.ablations(_two_legs(spark, sf_dir), VARIANTS, gold, "item_id", "doc_id", 5, "full")
