"""Second-stage ranking, query checks, sweeps and label rules on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import corpus as C
from tessera.operators import ranking as K
from tessera.operators import retrieval as R
from tessera.plans.relational import read
from tessera.plans.retrieval import LEGS, SEARCH, GOLD, _class_gold, _legs, _ranking_and_gold, _vector_queries
from tessera.plans.textual import WINDOWS, children

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


@query(f"WITH {SEARCH}, h AS (SELECT query_id, vec_id AS position, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM hits) WHERE r <= 60), u AS (SELECT vec_id AS position, vec_id % 40 AS unit_id FROM embeddings), c AS (SELECT DISTINCT vec_id % 40 AS unit_id, vec_id % 17 AS doc_id FROM embeddings) SELECT query_id, doc_id, max(score) AS score FROM h JOIN u USING (position) JOIN c USING (unit_id) GROUP BY 1, 2")
def dense_documents(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    hits = R.exact_topk(_vector_queries(spark, sf_dir), e, 60).select("query_id", F.col("vec_id").alias("position"), "score")
    units = e.select(F.col("vec_id").alias("position"), (F.col("vec_id") % 40).alias("unit_id"))
    kids = e.select((F.col("vec_id") % 40).alias("unit_id"), (F.col("vec_id") % 17).alias("doc_id")).distinct()
    return K.documents_of_hits(hits, units, kids, "query_id")


@query(f"WITH {LEGS} SELECT query_id, vec_id % 13 AS doc_id, vec_id, round(sum(CASE branch WHEN 'dense' THEN 1.0 ELSE 0.8 END / (60 + rank)) + max(0.5 / (60 + rank)), 9) AS score FROM top GROUP BY 1, 2, 3")
def child_fusion(spark, sf_dir):
    legs = _legs(spark, sf_dir).withColumn("doc_id", F.col("vec_id") % 13)
    return K.child_fusion(legs, "query_id", "doc_id", "vec_id", {"dense": 1.0, "sparse": 0.8}, global_rank="rank").withColumn("score", F.round("score", 9))


@query(f"WITH {LEGS}, s AS (SELECT query_id, vec_id % 13 AS doc_id, vec_id, 1.0 / (60 + rank) AS score FROM top WHERE branch = 'dense'), d AS (SELECT query_id, doc_id, max(score) AS d FROM s GROUP BY 1, 2), b AS (SELECT s.query_id, s.doc_id, vec_id, round(score + d, 9) AS score FROM s JOIN d USING (query_id, doc_id)), f AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY score DESC, vec_id) AS rn FROM b) SELECT query_id, doc_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM f WHERE rn <= 2")
def baseline_ranking(spark, sf_dir):
    s = _legs(spark, sf_dir).where("branch = 'dense'").select("query_id", (F.col("vec_id") % 13).alias("doc_id"), "vec_id", (1 / (60 + F.col("rank"))).alias("score"))
    d = R.max_per_document(s, ["query_id", "doc_id"])
    return K.baseline_ranking(d, s, "query_id", "doc_id", "vec_id", 2)


@query(f"WITH {SEARCH}, t AS (SELECT query_id, vec_id, score, (vec_id * 13) % 11 AS model, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM hits QUALIFY r <= 60), o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY model DESC, score DESC, vec_id) AS m FROM t) SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY round(0.7 / (60 + m) + 0.3 / (60 + r), 12) DESC, vec_id) AS place, m AS by_model FROM o")
def rerank_orders(spark, sf_dir):
    """rerank_orders of the 60 best of all vectors."""
    rows = R.exact_topk(_vector_queries(spark, sf_dir), read(spark, sf_dir, "embeddings"), 60).select("query_id", "vec_id", "score", F.expr("(vec_id * 13) % 11").alias("model"))
    alone = K.rerank(rows, "query_id", "vec_id", "model", "score").select("query_id", "vec_id", F.col("place").alias("by_model"))
    return K.rerank(rows, "query_id", "vec_id", "model", "score", share=0.7).select("query_id", "vec_id", "place").join(alone, ["query_id", "vec_id"])


@query(f"WITH {LEGS}, c AS (SELECT query_id, vec_id % 13 AS doc_id, vec_id, rank FROM top WHERE branch = 'dense'), d AS (SELECT query_id, doc_id, min(rank) AS d FROM c GROUP BY 1, 2) SELECT c.query_id, c.doc_id, vec_id, round(1 / (60 + d) + 1 / (60 + rank), 9) AS score FROM c JOIN d USING (query_id, doc_id)")
def mining_fusion(spark, sf_dir):
    c = _legs(spark, sf_dir).where("branch = 'dense'").select("query_id", (F.col("vec_id") % 13).alias("doc_id"), "vec_id", "rank")
    d = c.groupBy("query_id", "doc_id").agg(F.min("rank").alias("rank"))
    return K.mining_fusion(d, c, "query_id", "doc_id", "vec_id").withColumn("score", F.round("score", 9))


@query()
def suppressed_overlaps(spark, sf_dir):
    kids = children(spark, sf_dir).select(F.col("doc_id").alias("query_id"), "doc_id", "start_char", (F.col("end_char")).alias("end_char"), "chunk_order")
    return K.suppress_overlaps(kids, "query_id", "doc_id", "start_char", "end_char", "chunk_order", 2, 8)


@query(f"""WITH {WINDOWS}, r AS (SELECT c.doc_id, c.start_char, c.end_char, d.text AS t, greatest(0, 800 - (c.end_char - c.start_char)) AS room FROM c JOIN documents d ON c.doc_id = d.doc_id),
    s AS (SELECT *, greatest(0, start_char - room // 2) AS a, least(length(t), end_char + room - room // 2) AS b FROM r), p AS (SELECT *, substring(t, a + 1, start_char - a) AS head, substring(t, end_char + 1, b - end_char) AS tail FROM s),
    x AS (SELECT *, CASE WHEN a > 0 AND instr(head, chr(10)) > 0 THEN a + instr(head, chr(10)) ELSE a END AS parent_start, CASE WHEN b < length(t) AND instr(reverse(tail), chr(10)) > 0 THEN b - instr(reverse(tail), chr(10)) ELSE b END AS parent_end FROM p)
    SELECT doc_id, start_char, parent_start, parent_end, sha256(substring(t, parent_start + 1, parent_end - parent_start)) AS digest FROM x""")
def centred_parents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("source_text"))
    got = K.centred_parents(children(spark, sf_dir), docs, "doc_id", "source_text", 800)
    return got.select("doc_id", "start_char", "parent_start", "parent_end", F.sha2("parent_text", 256).alias("digest"))


@query("SELECT doc_id, sha256(array_to_string(list_filter([CASE WHEN trim(source) = trim(lang) THEN trim(source) ELSE trim(source) || chr(10) || chr(10) || trim(lang) END, text], lambda x: x <> ''), chr(10) || chr(10))) AS representation_hash FROM documents")
def dense_representation(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(K.dense_text(F.col("source"), F.col("lang"), F.col("text")), 256).alias("representation_hash"))


@query("WITH d AS (SELECT doc_id, len(string_split(text, ' ')) AS n FROM documents), g AS (SELECT doc_id, n, unnest(generate_series(0, greatest(1, CAST(ceil((n - 20) / 80) AS BIGINT)) - 1)) AS i FROM d) SELECT doc_id, i * 80 AS start, least(i * 80 + 100, n) AS \"end\" FROM g")
def passage_windows(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("w"))
    return d.select("doc_id", F.explode(K.passage_windows(F.col("w"), 100, 20)).alias("s")).select("doc_id", "s.start", "s.end")


@query(r"SELECT item_id, length(text) >= 120 AND regexp_matches(text, '(?i)[,;:]|\b(?:and|or|with|without|und|et|y|con)\b') AS is_complex FROM benchmark")
def query_complexity(spark, sf_dir):
    return read(spark, sf_dir, "benchmark").select("item_id", K.is_complex(F.col("text")).alias("is_complex"))


VARIANTS = r"""v AS (SELECT item_id, text AS q, CASE item_id % 4 WHEN 0 THEN ' ' WHEN 1 THEN text || ' 7' WHEN 2 THEN substr(text, 1, length(text) // 2) ELSE upper(text) END AS v, list_filter([split_part(text, ' ', 1), split_part(text, ' ', -1)], lambda t: t <> '') AS terms FROM benchmark)"""
FOLDED = "replace(replace(lower({}), 'ß', 'ss'), 'ς', 'σ')"


@query(f"""WITH {VARIANTS}, n AS (SELECT *, list_sort(regexp_extract_all(q, '\\d+(?:[.,]\\d+)?|[<>≤≥]=?')) AS a, list_sort(regexp_extract_all(v, '\\d+(?:[.,]\\d+)?|[<>≤≥]=?')) AS b FROM v)
    SELECT item_id, array_to_string(list_filter([CASE WHEN trim(v) = '' THEN 'EMPTY' END, CASE WHEN a <> b THEN 'NUMBERS_CHANGED' END, CASE WHEN len(list_filter(terms, lambda t: contains({FOLDED.format('q')}, {FOLDED.format('t')}) AND NOT contains({FOLDED.format('v')}, {FOLDED.format('t')}))) > 0 THEN 'PROTECTED_TERM_LOST' END], lambda x: x IS NOT NULL), ',') AS problems FROM n""")
def variant_checks(spark, sf_dir):
    """Rewritten forms of every benchmark item: emptied, with a number added, cut in half, in capitals."""
    q = F.col("text")
    v = F.when(F.expr("item_id % 4 = 0"), F.lit(" ")).when(F.expr("item_id % 4 = 1"), F.concat(q, F.lit(" 7"))).when(F.expr("item_id % 4 = 2"), F.expr("substring(text, 1, int(length(text) div 2))")).otherwise(F.upper(q))
    terms = F.filter(F.array(F.split_part(q, F.lit(" "), F.lit(1)), F.split_part(q, F.lit(" "), F.lit(-1))), lambda t: t != "")
    return read(spark, sf_dir, "benchmark").select("item_id", F.array_join(K.variant_problems(q, v, terms), ",").alias("problems"))


@query()
def expansion_checks(spark, sf_dir):
    """Expansions of every benchmark item: sound, no JSON, too many subqueries, and off the subject."""
    q = F.col("text")
    word = lambda i: F.split_part(q, F.lit(" "), F.lit(i))
    made = lambda subqueries, passage: F.to_json(F.struct(subqueries.alias("subqueries"), passage.alias("passage")))
    raw = F.when(F.expr("item_id % 4 = 0"), made(F.array(word(1)), word(2))).when(F.expr("item_id % 4 = 1"), F.lit("no json")).when(F.expr("item_id % 4 = 2"), made(F.array(word(1), word(2), word(3)), F.lit(""))).otherwise(made(F.array(F.lit("weather")), F.lit("x")))
    return read(spark, sf_dir, "benchmark").select("item_id", F.array_join(K.expansion_problems(raw, q), ",").alias("problems"))


@query("SELECT sha256(text) AS content_hash, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY 1")
def auxiliary_units(spark, sf_dir):
    return K.first_of_each(read(spark, sf_dir, "documents"), F.col("text"), "doc_id", ["source"])


GRID = [(m, x, g, f) for m in (1, 3, 5) for x in (5, 10, 20) for g in (None, 0.1, 0.3, 0.6) for f in (None, 0.2, 0.5, 0.8)]


@query(f"""WITH {GOLD}, grid(setting, minimum, maximum, margin, floor) AS (VALUES {", ".join(f"({i}, {m}, {x}, {'NULL::DOUBLE' if g is None else f'{g}::DOUBLE'}, {'NULL::DOUBLE' if f is None else f'{f}::DOUBLE'})" for i, (m, x, g, f) in enumerate(GRID))}),
    e AS (SELECT r.*, grid.*, max(score) OVER (PARTITION BY setting, query_id) AS top FROM (SELECT * FROM r WHERE rank <= 50) r CROSS JOIN grid),
    ok AS (SELECT *, row_number() OVER (PARTITION BY setting, query_id ORDER BY rank) AS place FROM e WHERE rank <= minimum OR (coalesce(score >= floor, true) AND coalesce(score >= top - margin, true))),
    k AS (SELECT * FROM ok WHERE place <= maximum), m AS (SELECT setting, query_id, count(*) AS np, count_if((query_id, vec_id) IN (SELECT (query_id, vec_id) FROM g)) AS hits FROM k GROUP BY ALL),
    n AS (SELECT query_id, count(*) AS ng FROM g GROUP BY 1), z AS (SELECT setting, CASE WHEN coalesce(hits, 0) > 0 THEN 5 * (hits / np) * (hits / ng) / (4 * (hits / np) + hits / ng) ELSE 0 END AS f2 FROM n CROSS JOIN (SELECT setting AS s FROM grid) LEFT JOIN m ON m.query_id = n.query_id AND m.setting = s)
    SELECT grid.*, round(avg(f2), 6) AS f2, (SELECT count(*) FROM k WHERE k.setting = grid.setting) AS size FROM grid JOIN z USING (setting) GROUP BY ALL""")
def cutoff_sweep(spark, sf_dir):
    ranking, gold = _ranking_and_gold(spark, sf_dir)
    return K.cutoff_sweep(ranking, gold, "query_id", "vec_id", [{"minimum": m, "maximum": x, "margin": g, "floor": f} for m, x, g, f in GRID])


@query(f"WITH {GOLD}, m AS (SELECT g.query_id, count(*) FILTER (WHERE rank <= 50) / count(*) AS a, count(*) FILTER (WHERE rank <= 10) / count(*) AS b FROM g LEFT JOIN r ON g.query_id = r.query_id AND g.vec_id = r.vec_id GROUP BY 1) SELECT 'candidates' AS stage, round(avg(a), 6) AS recall, count(*) FILTER (WHERE a = 0) AS lost FROM m UNION ALL SELECT 'final', round(avg(b), 6), count(*) FILTER (WHERE b = 0) FROM m")
def stage_recall(spark, sf_dir):
    ranking, gold = _ranking_and_gold(spark, sf_dir)
    return K.stage_recall(gold, {"candidates": ranking, "final": ranking.where(F.col("rank") <= 10)}, "query_id", "vec_id")


@query(f"WITH {GOLD}, o AS (SELECT query_id, vec_id FROM g WHERE query_id <> vec_id), m AS (SELECT o.query_id, bool_or(rank <= 50) AS c, bool_or(rank <= 10) AS t, bool_or(rank <= 3) AS f FROM o LEFT JOIN r ON o.query_id = r.query_id AND o.vec_id = r.vec_id GROUP BY 1) SELECT query_id, CASE WHEN f THEN 'FOUND' WHEN t THEN 'LOST_IN_SELECTION' WHEN c THEN 'LOST_IN_RANKING' ELSE 'NOT_RETRIEVED' END AS verdict FROM m")
def error_taxonomy(spark, sf_dir):
    ranking, _ = _ranking_and_gold(spark, sf_dir)
    return K.error_taxonomy(_class_gold(read(spark, sf_dir, "embeddings"), others=True), ranking, ranking.where(F.col("rank") <= 3), "query_id", "vec_id")


@query("WITH q AS (SELECT item_id, array_to_string(regexp_extract_all(replace(replace(lower(text), 'ß', 'ss'), 'ς', 'σ'), '[\\p{L}\\p{N}]+'), ' ') AS q FROM benchmark), t AS (SELECT * FROM q WHERE item_id % 2 = 0), h AS (SELECT item_id + item_id % 3 AS item_id, q FROM q WHERE item_id % 4 <> 0) SELECT 'shared_ids' AS \"check\", (SELECT count(DISTINCT t.item_id) FROM t WHERE item_id IN (SELECT item_id FROM h)) AS violations UNION ALL SELECT 'shared_texts', (SELECT count(DISTINCT q) FROM t WHERE q IN (SELECT q FROM h))")
def split_leaks(spark, sf_dir):
    b = read(spark, sf_dir, "benchmark")
    return K.split_leaks(b.where("item_id % 2 = 0"), b.where("item_id % 4 <> 0").withColumn("item_id", F.expr("item_id + item_id % 3")), "item_id", "text")


@query("SELECT doc_id AS pair_id, CASE WHEN doc_id % 7 = 0 THEN 'REJECTED' WHEN doc_id % 5 = 0 THEN 'CONFLICT' WHEN doc_id % 3 = 0 THEN 'PENDING' ELSE 'ok' END AS verdict FROM documents")
def review_import(spark, sf_dir):
    pairs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("pair_id"), "source")
    once = pairs.where("pair_id % 3 <> 0 OR pair_id % 7 = 0 OR pair_id % 5 = 0").select("pair_id", F.when(F.expr("pair_id % 7 = 0"), "x").otherwise(F.col("source")).alias("source"), F.lit("ok").alias("label"))
    twice = pairs.where("pair_id % 5 = 0").select("pair_id", "source", F.lit("bad").alias("label"))
    return K.reviewed(pairs, once.unionByName(twice), "pair_id", ["source"])


@query("SELECT count(*) AS \"rows\", round(min(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS least_cosine, 0.0 AS most_error, true AS agree FROM embeddings")
def vector_agreement(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return K.vector_agreement(e, e, "vec_id", "embedding")


@query("SELECT doc_id % 5 AS worker, count(*) AS assigned, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS completed, count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS remaining FROM documents GROUP BY 1")
def assignment_progress(spark, sf_dir):
    d, done = read(spark, sf_dir, "documents", "labels")
    return K.assignment_progress(d.select((F.col("doc_id") % 5).alias("worker"), "doc_id"), done, "worker", "doc_id")


@query("""WITH p AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id, text FROM documents), m AS (SELECT max(position) // 2 AS middle FROM p),
    d AS (SELECT position // 16 AS i, md5(string_agg(sha256(text), '' ORDER BY doc_id)) AS h, md5(string_agg(sha256(CASE WHEN position = middle THEN text || '!' ELSE text END), '' ORDER BY doc_id)) AS g FROM p, m GROUP BY 1)
    SELECT count(*) AS parts, coalesce(min(i) FILTER (WHERE h <> g), count(*)) AS reusable FROM d""")
def exact_prefix(spark, sf_dir):
    """Parts of sixteen documents, then parts of the same table with one document in the middle changed."""
    d = C.positions(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    middle = d.agg(F.floor(F.max("position") / 2)).first()[0]

    def parts(text):
        hashes = F.array_sort(F.collect_list(F.struct("doc_id", F.sha2(text, 256).alias("h"))))
        digest = F.md5(F.array_join(F.transform(hashes, lambda x: x["h"]), ""))
        return d.groupBy(F.floor(F.col("position") / 16).alias("i")).agg(digest.alias("h"))

    changed = F.when(F.col("position") == middle, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return K.exact_prefix(parts(F.col("text")), parts(changed), "i", "h")


@query()
def heading_hints(spark, sf_dir):
    first = F.trim(F.split("text", "\n")[0])
    return read(spark, sf_dir, "documents").select("doc_id", K.heading_hints(F.concat(F.lit("## "), first, F.lit("\nx\n# not there")), F.col("text")).alias("hints"))


@query("WITH a AS (SELECT doc_id % 4 AS shard, doc_id, source FROM documents) SELECT shard, count(*) AS records, count(DISTINCT doc_id) AS unique_ids, count(*) - count(DISTINCT doc_id) AS duplicates, count(*) FILTER (WHERE source = 'src0') AS hot FROM a GROUP BY 1")
def batch_coverage(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    parts = C.tagged_union([d.where(f"doc_id % 4 = {i}").select("doc_id", "source") for i in range(4)], "shard")
    return parts.groupBy("shard").agg(F.count("*").alias("records"), F.count_distinct("doc_id").alias("unique_ids"), (F.count("*") - F.count_distinct("doc_id")).alias("duplicates"), F.count_if(F.col("source") == "src0").alias("hot"))
