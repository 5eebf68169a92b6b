"""Lexical, vector and fused retrieval with its evaluation, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import corpus as C
from tessera.operators import evaluation as E
from tessera.operators import intake as I
from tessera.operators import retrieval as R
from tessera.operators import spans as S
from tessera.operators import vector_index as V
from tessera.plans.relational import read
from tessera.plans.textual import children
from tessera.session import materialise, sent_if_few

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


TOKENS = "regexp_extract_all(replace(replace(lower({}), 'ß', 'ss'), 'ς', 'σ'), '[\\p{{L}}\\p{{N}}]+')"


def bm25_sql(name: str, source: str, key: str, text: str, part: str = "") -> str:
    """CTEs of a BM25 leg named `name`; part: a grouping column for local collections."""
    by = f"{part}, " if part else ""
    on = f" AND t.{part} = s.{part}" if part else ""
    on_df = f" AND t.{part} = f.{part}" if part else ""
    return f"""{name}_d AS (SELECT {by}{key}, {TOKENS.format(text)} AS w FROM {source}), {name}_s AS (SELECT {by}count(*) AS n, greatest(avg(len(w)), 1.0) AS a FROM {name}_d {"GROUP BY " + part if part else ""}),
    {name}_t AS (SELECT {by}{key}, term, count(*) AS tf, any_value(l) AS l FROM (SELECT {by}{key}, len(w) AS l, unnest(w) AS term FROM {name}_d) GROUP BY {by}{key}, term),
    {name}_f AS (SELECT {by}term, count(*) AS df FROM {name}_t GROUP BY {by}term),
    {name} AS (SELECT q.item_id, {"t." + part + ", " if part else ""}t.{key}, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * l / a))) AS score
        FROM terms q JOIN {name}_t t ON q.term = t.term JOIN {name}_f f ON f.term = t.term{on_df} JOIN {name}_s s ON true{on} GROUP BY ALL)"""


#: The distinct terms of every benchmark item.
ALL_TERMS = f"terms AS (SELECT DISTINCT item_id, unnest({TOKENS.format('text')}) AS term FROM benchmark)"


def _words(c="text"):
    return T.words(F.col(c))


@query(f"WITH {ALL_TERMS}, {bm25_sql('b', 'documents', 'doc_id', 'text')} SELECT item_id, doc_id, score, rank FROM (SELECT item_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM b) WHERE rank <= 20")
def bm25_topk(spark, sf_dir):
    docs, q = read(spark, sf_dir, "documents", "benchmark")
    return R.bm25_topk(q, "item_id", _words(), docs, ["doc_id"], {"text": (_words(), 1.0)}, 20)


@query(f"WITH {ALL_TERMS}, h AS (SELECT doc_id, split_part(text, chr(10), 1) AS head, text FROM documents), {bm25_sql('x', 'h', 'doc_id', 'head')}, {bm25_sql('y', 'h', 'doc_id', 'text')}, u AS (SELECT item_id, doc_id, sum(s) AS score FROM (SELECT item_id, doc_id, 2.0 * score AS s FROM x UNION ALL SELECT item_id, doc_id, score FROM y) GROUP BY 1, 2) SELECT item_id, doc_id, score, rank FROM (SELECT item_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM u) WHERE rank <= 10")
def bm25_fielded(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("head", F.split_part("text", F.lit("\n"), F.lit(1)))
    fields = {"head": (_words("head"), 2.0), "body": (_words(), 1.0), "aliases": (_words("head"), 0.0)}
    return R.bm25_topk(read(spark, sf_dir, "benchmark"), "item_id", _words(), docs, ["doc_id"], fields, 10)


CHILDREN = "w AS (SELECT doc_id, unnest(generate_series(0, greatest(0, length(text) - 1), 400)) AS s, length(text) AS n, text FROM documents WHERE length(text) > 0), c AS (SELECT doc_id, s // 400 AS chunk_order, substring(text, s + 1, least(s + 500, n) - s) AS text FROM w WHERE s = 0 OR s + 100 < n)"


@query(f"WITH {CHILDREN}, {ALL_TERMS}, {bm25_sql('b', 'c', 'chunk_order', 'text', 'doc_id')} SELECT item_id, doc_id, chunk_order, round(score, 6) AS score FROM b")
def bm25_local(spark, sf_dir):
    """A document's windows are one row, so no row of the result is shuffled."""
    docs = S.window_arrays(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", 500, 400)
    got = R.bm25_within(read(spark, sf_dir, "benchmark"), "item_id", _words(), docs, "doc_id", F.transform("__w", T.words), "chunk_order")
    return got.withColumn("score", F.round("score", 6))


@query("SELECT partition, count(*) AS n FROM (SELECT CASE WHEN lang IN ('en', 'de') THEN [lang] ELSE ['en', 'de'] END AS p FROM documents), unnest(p) AS t(partition) GROUP BY 1")
def language_fan_out(spark, sf_dir):
    return R.by_language(read(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", ["en", "de"]).groupBy("partition").agg(F.count("*").alias("n"))


@query("WITH g(entry, alias) AS (VALUES (1, 'the of'), (1, 'and'), (2, 'with'), (2, 'den'), (3, 'zzzz')), w AS (SELECT item_id, ' ' || array_to_string(" + TOKENS.format("text") + ", ' ') || ' ' AS t FROM benchmark), h AS (SELECT DISTINCT item_id, entry FROM w JOIN g ON contains(t, ' ' || alias || ' ')) SELECT item_id, array_to_string(list_sort(list_distinct(list(alias))), '|') AS aliases FROM h JOIN g USING (entry) GROUP BY 1")
def alias_enrichment(spark, sf_dir):
    glossary = spark.createDataFrame([(1, "the of"), (1, "and"), (2, "with"), (2, "den"), (3, "zzzz")], "entry int, alias string")
    found = R.with_aliases(read(spark, sf_dir, "benchmark"), "item_id", "text", glossary)
    return found.withColumn("aliases", F.array_join("aliases", "|"))


@query("""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) SELECT 'null_vector' AS "check", (SELECT count(*) FROM e WHERE v IS NULL) AS violations UNION ALL SELECT 'wrong_dimension', (SELECT count(*) FROM e WHERE len(v) <> 64)
    UNION ALL SELECT 'non_finite', 0 UNION ALL SELECT 'not_unit', (SELECT count(*) FROM e WHERE abs(sqrt(list_inner_product(v, v)) - 1) > 1e-4) UNION ALL SELECT 'duplicate_key', (SELECT count(*) - count(DISTINCT vec_id) FROM e)""")
def vector_validate(spark, sf_dir):
    return R.vector_problems(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)


SEARCH = "q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 50 = 0), hits AS (SELECT query_id, vec_id, round(list_inner_product(q.v, e.embedding::DOUBLE[]), 6) AS score FROM q, embeddings e)"


def _vector_queries(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query(f"WITH {SEARCH} SELECT query_id, vec_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM hits) WHERE rank <= 10")
def cosine_topk(spark, sf_dir):
    return R.exact_topk(_vector_queries(spark, sf_dir), read(spark, sf_dir, "embeddings"), 10)


@query(f"WITH {SEARCH}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM hits), u AS (SELECT query_id, e.label AS doc_id, score FROM r JOIN embeddings e USING (vec_id) WHERE rank <= 40) SELECT query_id, doc_id, max(score) AS score FROM u GROUP BY 1, 2")
def maxp_documents(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    hits = R.exact_topk(_vector_queries(spark, sf_dir), e, 40).join(e.select("vec_id", F.col("label").alias("doc_id")), "vec_id")
    return R.max_per_document(hits, ["query_id", "doc_id"])


@query()
def ann_recall_gate(spark, sf_dir):
    """Stored index with byte codes, its probes doubled until sampled queries reach the recall."""
    q, e = _vector_queries(spark, sf_dir), read(spark, sf_dir, "embeddings")
    found, recall, probes = V.gated_search(V.build(e), q, e, 10)
    return found.withColumns({"recall": F.lit(recall), "probes": F.lit(probes)})


@query()
def candidate_rescore(spark, sf_dir):
    """Exact scores of the inverted-file search's hits, each query's own candidates."""
    e, q = read(spark, sf_dir, "embeddings"), _vector_queries(spark, sf_dir)
    pairs = V.search(V.build(e), q, e, 10, 4).select("query_id", "vec_id")
    return R.rescore(pairs, q, e, "query_id", "vec_id").withColumn("score", F.round("score", 6))


LEGS = f"{SEARCH}, hr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM hits), legs AS (SELECT query_id, 'dense' AS branch, vec_id, r AS rank, score FROM hr WHERE r <= 30 UNION ALL SELECT query_id, 'sparse', vec_id, row_number() OVER (PARTITION BY query_id ORDER BY (vec_id * 31 + query_id) % 97, vec_id), (vec_id * 31 + query_id) % 97 FROM hr WHERE r <= 80), top AS (SELECT * FROM legs WHERE rank <= 30)"


def _legs(spark, sf_dir):
    """Two branches over the same hits: by inner product, and by a made-up other score."""
    from pyspark.sql import Window

    hits = materialise(R.exact_topk(_vector_queries(spark, sf_dir), read(spark, sf_dir, "embeddings"), 80), "legs")
    dense = hits.where("rank <= 30").withColumn("branch", F.lit("dense"))
    other = hits.withColumn("score", F.expr("(vec_id * 31 + query_id) % 97").cast("double"))
    sparse = other.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where("rank <= 30").withColumn("branch", F.lit("sparse"))
    return dense.unionByName(sparse)


@query(f"WITH {LEGS} SELECT query_id, vec_id, round(sum(CASE branch WHEN 'dense' THEN 1.0 ELSE 0.8 END / (60 + rank)), 9) AS score FROM top GROUP BY 1, 2")
def rrf_fuse(spark, sf_dir):
    return R.weighted_rrf(_legs(spark, sf_dir), "query_id", "vec_id", {"dense": 1.0, "sparse": 0.8, "none": 0.0}).select("query_id", "vec_id", F.round("score", 9).alias("score"))


@query(f"WITH {LEGS} SELECT query_id, vec_id, max(rank) FILTER (WHERE branch = 'dense') AS dense_rank, max(rank) FILTER (WHERE branch = 'sparse') AS sparse_rank FROM top GROUP BY 1, 2")
def weighted_rrf_evidence(spark, sf_dir):
    fused = R.weighted_rrf(_legs(spark, sf_dir), "query_id", "vec_id", {"dense": 1.0, "sparse": 0.8})
    return fused.select("query_id", "vec_id", F.try_element_at("evidence", F.lit("dense"))["rank"].alias("dense_rank"), F.try_element_at("evidence", F.lit("sparse"))["rank"].alias("sparse_rank"))


@query(f"WITH {SEARCH}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM hits), t AS (SELECT *, max(score) OVER (PARTITION BY query_id) AS best FROM r WHERE rank <= 20), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS rn FROM t WHERE rank <= 3 OR (score >= 0.2 AND score >= best - 0.75)) SELECT query_id, vec_id, score, rank FROM k WHERE rn <= 8")
def cutoff_policy(spark, sf_dir):
    top = R.exact_topk(_vector_queries(spark, sf_dir), read(spark, sf_dir, "embeddings"), 20)
    return R.cutoff(top, "query_id", "rank", "score", 3, 8, margin=0.75, floor=0.2)


@query(f"WITH {LEGS} SELECT query_id, vec_id, round(coalesce(max(score) FILTER (WHERE branch = 'dense'), 0) + 0.5 * coalesce(max(score) FILTER (WHERE branch = 'sparse'), 0), 6) AS score FROM top GROUP BY 1, 2")
def maxp_two_legs(spark, sf_dir):
    return R.maxp_legs(_legs(spark, sf_dir), ["query_id", "vec_id"], "branch", "score", "dense", "sparse", 0.5).withColumn("score", F.round("score", 6))


GOLD = f"{SEARCH}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM hits), g AS (SELECT q.vec_id AS query_id, e.vec_id FROM embeddings q JOIN embeddings e ON q.label = e.label WHERE q.vec_id % 50 = 0)"


def _class_gold(e, others: bool = False):
    """The gold of a vector query: all vectors of its label."""
    return E.ClassGold(e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "label"), e, "query_id", "vec_id", "label", others)


def _ranking_and_gold(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    # written once: its readers take it more than once, and the search is the work
    ranking = materialise(R.exact_topk(_vector_queries(spark, sf_dir), e, 50), "ranking")
    return ranking, _class_gold(e)


@query(f"WITH {GOLD}, k(k) AS (VALUES (1), (10), (50)), each AS (SELECT g.query_id, k.k, count(*) FILTER (WHERE r.rank <= k.k) / count(*) AS r FROM g JOIN r ON g.query_id = r.query_id AND g.vec_id = r.vec_id CROSS JOIN k GROUP BY 1, 2) SELECT k, round(avg(r), 6) AS recall, count(*) AS queries FROM each GROUP BY 1")
def recall_at_k(spark, sf_dir):
    return E.recall_at(*_ranking_and_gold(spark, sf_dir), "query_id", "vec_id", [1, 10, 50])


@query(f"WITH {GOLD}, h AS (SELECT g.query_id, 1 / min(rank) AS rr, sum(1 / log2(rank + 1)) AS dcg FROM g JOIN r ON g.query_id = r.query_id AND g.vec_id = r.vec_id WHERE rank <= 10 GROUP BY 1), n AS (SELECT query_id, count(*) AS n FROM g GROUP BY 1), i AS (SELECT query_id, n, list_sum(list_transform(generate_series(1, least(n, 10)), lambda i: 1 / log2(i + 1))) AS idcg FROM n) SELECT count(*) AS queries, round(avg(coalesce(rr, 0)), 6) AS mrr, round(avg(coalesce(dcg, 0) / idcg), 6) AS ndcg FROM i LEFT JOIN h ON i.query_id = h.query_id")
def mrr_ndcg(spark, sf_dir):
    return E.mrr_ndcg(*_ranking_and_gold(spark, sf_dir), "query_id", "vec_id")


F2_SQL = f"WITH {GOLD}, p AS (SELECT query_id, vec_id FROM r WHERE rank <= 10), m AS (SELECT g.query_id, count(p.vec_id) AS hits, count(*) AS ng FROM g LEFT JOIN p ON g.query_id = p.query_id AND g.vec_id = p.vec_id GROUP BY 1), z AS (SELECT query_id, hits / 10 AS precision, hits / ng AS recall FROM m), f AS (SELECT *, CASE WHEN precision > 0 OR recall > 0 THEN 5 * precision * recall / (4 * precision + recall) ELSE 0 END AS f2 FROM z)"


@query(F2_SQL + " SELECT count(*) AS queries, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f2), 6) AS f2 FROM f")
def f2_macro(spark, sf_dir):
    ranking, gold = _ranking_and_gold(spark, sf_dir)
    return E.macro(E.document_metrics(ranking.where("rank <= 10"), gold, "query_id", "vec_id"))


@query(f"WITH {LEGS}, g AS (SELECT q.vec_id AS query_id, e.vec_id FROM embeddings q JOIN embeddings e ON q.label = e.label WHERE q.vec_id % 50 = 0), f AS (SELECT DISTINCT t.query_id, t.vec_id, branch FROM top t JOIN g ON t.query_id = g.query_id AND t.vec_id = g.vec_id), n AS (SELECT *, count(*) OVER (PARTITION BY query_id, vec_id) AS n FROM f) SELECT branch, count(*) AS hits, count(*) FILTER (WHERE n = 1) AS only FROM n GROUP BY 1")
def branch_unique_hits(spark, sf_dir):
    return E.unique_hits(_legs(spark, sf_dir), _class_gold(read(spark, sf_dir, "embeddings")), "query_id", "vec_id")


@query()
def evaluation_regression(spark, sf_dir):
    ranking, gold = _ranking_and_gold(spark, sf_dir)
    metric = lambda n: E.document_metrics(ranking.where(F.col("rank") <= n), gold, "query_id", "vec_id")
    return E.regression(metric(5), metric(20), "query_id", "f2")


@query()
def lcs_similarity(spark, sf_dir):
    kids = children(spark, sf_dir).select("doc_id", "chunk_order", _words().alias("w"))
    following = kids.select("doc_id", (F.col("chunk_order") - 1).alias("chunk_order"), F.col("w").alias("w2"))
    pairs = kids.join(following, ["doc_id", "chunk_order"])
    common = R.lcs(F.col("w"), F.col("w2"))
    return pairs.select("doc_id", "chunk_order", F.size("w").alias("n1"), F.size("w2").alias("n2"), common.alias("common"))


def _candidates(spark, sf_dir):
    """The 60 best windows of each item; texts are read, and words cut, for these alone."""
    kids = children(spark, sf_dir).select("doc_id", "chunk_order", "text")
    hits = R.bm25_topk(read(spark, sf_dir, "benchmark"), "item_id", _words(), kids, ["doc_id", "chunk_order"], {"text": (_words(), 1.0)}, 60)
    hits = materialise(hits.select("item_id", F.concat_ws(":", "doc_id", "chunk_order").alias("child"), "score", "rank", "doc_id", "chunk_order"), "candidates")
    found = kids.join(sent_if_few(hits, hits), ["doc_id", "chunk_order"]).withColumn("tokens", _words()).drop("text", "chunk_order")
    return materialise(found, "candidates")  # as many rows as hits; its readers take them more than once


@query()
def select_parents(spark, sf_dir):
    return R.select_passages(_candidates(spark, sf_dir), "item_id", "doc_id", "child", "tokens", "rank", per_doc=2, most=8)


@query()
def chunk_f2(spark, sf_dir):
    c = _candidates(spark, sf_dir)
    predicted = c.where("rank <= 8").select("item_id", "doc_id", "tokens", F.col("rank").alias("place"))
    return E.chunk_metrics(predicted, c.where("rank <= 3").select("item_id", "doc_id", "tokens"), "item_id", "doc_id", "tokens")


@query("WITH s AS (SELECT doc_id, start_char AS a, start_char + 30 + doc_id % 200 AS b FROM (SELECT doc_id, unnest(generate_series(0, n_chars, 120)) AS start_char FROM documents)), m AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s), i AS (SELECT *, sum(CASE WHEN before IS NULL OR a > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a, b) AS island FROM m) SELECT doc_id, min(a) AS a, max(b) AS b, count(*) AS merged FROM i GROUP BY doc_id, island")
def merged_spans(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chars"), F.lit(120).cast("long"))).alias("a"))
    return R.merged_spans(d.withColumn("b", F.col("a") + 30 + F.col("doc_id") % 200), ["doc_id"], "a", "b")


GROUPS = "WITH RECURSIVE e AS (SELECT d.doc_id AS x, m.m AS y FROM documents d JOIN (SELECT sha256(text) AS h, min(doc_id) AS m FROM documents GROUP BY 1) m ON sha256(d.text) = m.h UNION SELECT d.doc_id, m.m FROM documents d JOIN (SELECT sha256(split_part(text, chr(10), 1)) AS h, min(doc_id) AS m FROM documents GROUP BY 1) m ON sha256(split_part(d.text, chr(10), 1)) = m.h), b AS (SELECT x, y FROM e WHERE x <> y UNION SELECT y, x FROM e WHERE x <> y), r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, b.y FROM r JOIN b ON r.y = b.x), grouped AS (SELECT x AS doc_id, min(y) AS \"group\" FROM r GROUP BY 1)"


@query(f"{GROUPS} SELECT * FROM grouped")
def connected_groups(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "text", F.split_part("text", F.lit("\n"), F.lit(1)).alias("head"))
    return E.duplicate_groups(d, "doc_id", ["text", "head"])


@query(f"{GROUPS}, p AS (SELECT *, ('0x' || substr(sha256('5:' || \"group\"), 1, 8))::BIGINT / 4294967296.0 AS place FROM grouped) SELECT doc_id, \"group\", CASE WHEN place < 0.8 THEN 'train' WHEN place < 0.9 THEN 'dev' ELSE 'held_out' END AS split FROM p")
def group_splits(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "text", F.split_part("text", F.lit("\n"), F.lit(1)).alias("head"))
    return E.split_groups(E.duplicate_groups(d, "doc_id", ["text", "head"]), "doc_id", "group", 5, {"train": 0.8, "dev": 0.1, "held_out": 0.1})


@query(f"WITH {SEARCH}, c AS (SELECT query_id, vec_id, 'c' || vec_id % 5 AS category, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM hits), t AS (SELECT * FROM c WHERE rank <= 30), l AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY query_id, category ORDER BY rank, vec_id) > CASE category WHEN 'c0' THEN 2 WHEN 'c1' THEN 2 WHEN 'c2' THEN 1 ELSE 0 END THEN 1 ELSE 0 END AS late FROM t), p AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY late, rank, vec_id) AS place FROM l) SELECT query_id, vec_id, category, rank, place FROM p WHERE place <= 7")
def hard_negative_mining(spark, sf_dir):
    top = R.exact_topk(_vector_queries(spark, sf_dir), read(spark, sf_dir, "embeddings"), 30).withColumn("category", F.concat(F.lit("c"), (F.col("vec_id") % 5).cast("string")))
    return E.hard_negatives(top.select("query_id", "vec_id", "category", "rank"), "query_id", "vec_id", "category", "rank", {"c0": 2, "c1": 2, "c2": 1}, 7)


@query()
def budget_packing(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(C.modulo_worker(F.sha2("text", 256), 16).alias("worker"), "doc_id", "n_chars")
    return I.pack_by_budget(d, "worker", "doc_id", "n_chars", 50_000)


@query()
def token_budget_batches(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(C.modulo_worker(F.sha2("text", 256), 16).alias("worker"), "doc_id", F.size(_words()).alias("tokens"))
    return I.token_batches(d, "worker", "doc_id", "tokens", 4096)
