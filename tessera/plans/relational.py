"""Corpus algebra on the driver's tables. Keys name operators; the README maps them to inventory lines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import corpus as C
from tessera.functions import urls

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def read(spark, sf_dir, *names):
    got = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return got[0] if len(got) == 1 else got


@query("SELECT count(*) AS \"rows\", count(DISTINCT doc_id) AS unique_ids, count(*) FILTER (WHERE doc_id IS NULL) AS null_ids, min(doc_id) AS min_id, max(doc_id) AS max_id, count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS empty_text FROM documents")
def audit_key_profile(spark, sf_dir):
    return C.key_profile(read(spark, sf_dir, "documents"), "doc_id", "text")


@query("SELECT min(length(text)) AS least, round(quantile_cont(length(text), 0.5), 6) AS p50, round(quantile_cont(length(text), 0.95), 6) AS p95, max(length(text)) AS most FROM documents")
def audit_text_lengths(spark, sf_dir):
    return C.length_quantiles(read(spark, sf_dir, "documents"), F.length("text"))


INVENTORY = r"""
    cut AS (SELECT page_id AS id, url, split_part(url, '#', 1) AS canonical_url, split_part(split_part(url, '#', 1), '?', 1) AS plain, position('://' IN url) AS colon FROM pages),
    sides AS (SELECT *, left(url, colon - 1) AS head, substr(url, colon + 3) AS tail, colon > 0 AND lower(left(url, colon - 1)) IN ('http', 'https') AS web FROM cut),
    base AS (SELECT id, url, canonical_url, CASE WHEN web AND head = lower(head) THEN head ELSE '' END AS scheme,
        CASE WHEN web THEN lower(string_split_regex(tail, '[/:?#]')[1]) ELSE '' END AS domain,
        CASE WHEN web AND contains(substr(plain, colon + 3), '/') THEN substr(plain, colon + 2 + position('/' IN substr(plain, colon + 3))) ELSE '' END AS path,
        CASE WHEN contains(plain, '.') AND regexp_full_match(string_split(plain, '.')[-1], '[a-zA-Z0-9]+') THEN lower(string_split(plain, '.')[-1]) ELSE '' END AS extension,
        web AND string_split_regex(tail, '[/?#\s]')[1] <> '' AS url_valid FROM sides),
    counted AS (SELECT domain, count(*) AS population FROM base GROUP BY ALL),
    placed AS (SELECT *, rank() OVER (ORDER BY population DESC, domain) AS domain_rank FROM counted),
    hints AS (SELECT base.*, population, domain_rank, if(domain_rank > 300, 'long_tail', if(domain_rank > 30, 'medium', 'top')) AS domain_tier,
        CASE extension WHEN 'pdf' THEN 'pdf' WHEN 'xml' THEN 'xml' ELSE if(list_contains(['', 'html', 'htm', 'php', 'aspx'], extension), 'html_like', 'other') END AS format_hint,
        coalesce(map {'vn': 'vi_like', 'cn': 'zh_like'}[if(contains(domain, '.'), string_split(domain, '.')[-1], '')], 'unknown') AS language_hint FROM base JOIN placed USING (domain)),
    strata AS (SELECT *, concat_ws(':', domain_tier, format_hint, language_hint, if(url_valid, 'valid', 'invalid')) AS stratum FROM hints)"""


def inventory(spark, sf_dir):
    return C.url_inventory(read(spark, sf_dir, "pages"), "page_id", "url")


@query(f"WITH {INVENTORY} SELECT * FROM base")
def url_inventory(spark, sf_dir):
    return inventory(spark, sf_dir)


@query(f"WITH {INVENTORY} SELECT id, domain, population, domain_rank, domain_tier, format_hint, language_hint, stratum FROM strata")
def domain_rank_tiers(spark, sf_dir):
    return C.with_strata(inventory(spark, sf_dir)).select("id", "domain", "population", "domain_rank", "domain_tier", "format_hint", "language_hint", "stratum")


@query(f"WITH {INVENTORY} SELECT id, domain FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY id) AS rn FROM base) WHERE rn <= 2")
def first_n_per_domain(spark, sf_dir):
    return C.first_per_group(inventory(spark, sf_dir).select("id", "domain"), 2, ["domain"], ["id"])


SAMPLE = """
    keyed AS (SELECT id, domain, stratum, (sha256('11:' || id), id) AS own, sha256('11:' || domain) AS theirs, sha256('11:' || stratum) AS whole FROM strata),
    turns AS (SELECT *, count(*) OVER (PARTITION BY stratum, domain ORDER BY own) AS turn FROM keyed),
    seats AS (SELECT *, count(*) OVER (PARTITION BY stratum ORDER BY (turn, theirs, id)) AS seat FROM turns),
    pilot AS (SELECT id, domain, stratum FROM seats QUALIFY count(*) OVER (ORDER BY (seat, whole, id)) <= 100)"""


@query(f"WITH {INVENTORY}, {SAMPLE} SELECT * FROM pilot")
def stratified_sample(spark, sf_dir):
    return C.stratified_sample(C.with_strata(inventory(spark, sf_dir)), 100, 11)


@query(f"WITH {INVENTORY}, {SAMPLE} SELECT s.stratum, s.population, coalesce(p.sample_rows, 0) AS sample_rows FROM (SELECT stratum, count(*) AS population FROM strata GROUP BY 1) s LEFT JOIN (SELECT stratum, count(*) AS sample_rows FROM pilot GROUP BY 1) p ON p.stratum = s.stratum")
def stratum_counts(spark, sf_dir):
    strata = C.with_strata(inventory(spark, sf_dir))
    return C.population_and_sample(strata, C.stratified_sample(strata, 100, 11), "stratum")


@query(r"SELECT page_id, split_part(trim(url), '#', 1) AS fetch_url, CASE WHEN regexp_matches(url, '(?i)^https?://[^/?#\s@]+(?:[/?#]|$)') THEN lower(regexp_extract(url, '(?i)^https?://([^/:?#\s]+)', 1)) END AS host, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS authority, rtrim(regexp_extract(url, '(?i)^https?://[^/?#]+([^?#]*)', 1), '/') <> '' AS redirected_home FROM pages")
def url_hosts(spark, sf_dir):
    u = F.col("url")
    root = F.concat(urls.scheme(u), F.lit("://"), urls.authority(u), F.lit("/"))
    return read(spark, sf_dir, "pages").select("page_id", urls.fetch_url(u).alias("fetch_url"), urls.strict_host(u).alias("host"), urls.authority(u).alias("authority"), urls.redirected_home(u, root).alias("redirected_home"))


@query("SELECT split_part(trim(url), '#', 1) AS fetch_url, min(page_id) AS crawl_url_id, count(*) AS doc_count FROM pages GROUP BY 1")
def frontier_aliases(spark, sf_dir):
    return C.frontier(read(spark, sf_dir, "pages"), "page_id", "url")


@query("WITH f AS (SELECT split_part(trim(url), '#', 1) AS fetch_url, min(page_id) AS crawl_url_id, count(*) AS doc_count FROM pages GROUP BY 1) SELECT p.page_id, f.crawl_url_id, f.doc_count FROM pages p JOIN f ON split_part(trim(p.url), '#', 1) = f.fetch_url")
def computed_key_alias_join(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return C.alias_join(pages, C.frontier(pages, "page_id", "url"), "page_id", "url", "fetch_url").select("page_id", "crawl_url_id", "doc_count")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')")
def missing_outcomes_anti(spark, sf_dir):
    orders, lines = read(spark, sf_dir, "orders", "lineitem")
    return C.missing(orders.select("o_orderkey", "o_custkey", "o_totalprice"), lines.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("SELECT s.doc_id, s.url FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN source || 'x' WHEN doc_id % 11 = 0 THEN NULL ELSE source END AS url FROM documents) s LEFT JOIN (SELECT doc_id, source AS url FROM documents WHERE doc_id % 5 > 0) o ON s.doc_id = o.doc_id WHERE o.doc_id IS NULL OR s.url IS DISTINCT FROM o.url")
def subset_pair_check(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    subset = docs.select("doc_id", F.when(F.expr("doc_id % 7 = 0"), F.concat("source", F.lit("x"))).when(F.expr("doc_id % 11 = 0"), None).otherwise(F.col("source")).alias("url"))
    return C.pair_mismatches(subset, docs.where("doc_id % 5 > 0").select("doc_id", F.col("source").alias("url")), "doc_id", "url")


@query("SELECT o_custkey, CASE WHEN NOT EXISTS (SELECT 1 FROM orders o2 WHERE o2.o_custkey = o.o_custkey AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o2.o_orderkey AND l.l_quantity > 20)) THEN 'REUSED' ELSE 'QUEUED' END AS action FROM (SELECT DISTINCT o_custkey FROM orders) o")
def relational_division(spark, sf_dir):
    orders, lines = read(spark, sf_dir, "orders", "lineitem")
    have = lines.where("l_quantity > 20").select(F.col("l_orderkey").alias("o_orderkey"))
    return C.division(orders, orders.select("o_custkey", "o_orderkey"), have, "o_custkey", "o_orderkey")


def _sources(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return [docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 <> 1").withColumn("lang", F.when(F.expr("doc_id % 6 = 2"), "xx").otherwise(F.col("lang")))]


UNION = "u AS (SELECT doc_id, text, lang, source, 0 AS origin FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, text, CASE WHEN doc_id % 6 = 2 THEN 'xx' ELSE lang END, source, 1 FROM documents WHERE doc_id % 3 <> 1)"


@query(f"WITH {UNION} SELECT origin, count(*) AS \"rows\", count(DISTINCT doc_id) AS ids FROM u GROUP BY origin")
def tagged_union(spark, sf_dir):
    return C.tagged_union(_sources(spark, sf_dir)).groupBy("origin").agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids"))


@query(f"WITH {UNION} SELECT doc_id, origin, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN lang = 'xx' THEN 1 ELSE 0 END, origin) AS rn FROM u) WHERE rn = 1")
def union_first_wins(spark, sf_dir):
    u = C.tagged_union(_sources(spark, sf_dir))
    chosen = C.first_source(u, "doc_id", [F.when(F.col("lang") == "xx", 1).otherwise(0), F.col("origin")])
    return u.join(chosen, ["doc_id", "origin"], "left_semi").select("doc_id", "origin", "lang", "source")


@query(f"WITH {UNION} SELECT doc_id, count(DISTINCT lang) AS n_lang, count(DISTINCT source) AS n_source FROM u GROUP BY doc_id HAVING count(DISTINCT lang) > 1 OR count(DISTINCT source) > 1")
def union_conflict_having(spark, sf_dir):
    return C.union_conflicts(C.tagged_union(_sources(spark, sf_dir)), "doc_id", ["lang", "source"])


PRINTS = f"""{UNION}, f AS (SELECT doc_id, origin, count(*) AS n, sha256(string_agg(sha256(coalesce(lang, chr(0)) || chr(31) || coalesce(source, chr(0)) || chr(31) || coalesce(text, chr(0))), '' ORDER BY sha256(coalesce(lang, chr(0)) || chr(31) || coalesce(source, chr(0)) || chr(31) || coalesce(text, chr(0))))) AS digest FROM u GROUP BY 1, 2)"""


@query(f"WITH {PRINTS} SELECT doc_id, origin, n AS \"rows\", digest FROM f")
def span_fingerprints(spark, sf_dir):
    return C.group_fingerprint(C.tagged_union(_sources(spark, sf_dir)), ["doc_id", "origin"], ["lang", "source", "text"])


@query(f"WITH {PRINTS} SELECT doc_id, count(DISTINCT origin) AS origins, count(DISTINCT (digest, n)) AS versions FROM f GROUP BY doc_id HAVING count(DISTINCT origin) > 1 AND count(DISTINCT (digest, n)) > 1")
def span_fingerprint_equality(spark, sf_dir):
    prints = C.group_fingerprint(C.tagged_union(_sources(spark, sf_dir)), ["doc_id", "origin"], ["lang", "source", "text"])
    return C.fingerprints_agree(prints, "doc_id")


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents")
def position_ordinals(spark, sf_dir):
    return C.positions(read(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "position")


@query("SELECT position // 64 AS part, min(position) AS first, max(position) AS last, count(*) AS \"rows\" FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents) GROUP BY 1")
def range_parts(spark, sf_dir):
    return C.range_parts(C.positions(read(spark, sf_dir, "documents").select("doc_id"), "doc_id"), 64)


@query("WITH p AS (SELECT position // 64 AS part, min(position) AS first, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents) GROUP BY 1), q AS (SELECT * FROM p WHERE part % 5 <> 2) SELECT part, first, n, expected FROM (SELECT *, lag(first + n) OVER (ORDER BY first) AS expected FROM q) WHERE expected <> first")
def range_completeness(spark, sf_dir):
    parts = C.range_parts(C.positions(read(spark, sf_dir, "documents").select("doc_id"), "doc_id"), 64).where("part % 5 <> 2")
    return C.range_complete(parts.select("part", "first", F.col("rows").alias("n")), "first", "n")


@query("SELECT doc_id, source FROM documents WHERE doc_id > 100 ORDER BY doc_id LIMIT 50")
def keyset_page(spark, sf_dir):
    return C.keyset_page(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 100, 50)


@query("SELECT sha256(text) AS content_hash, min(doc_id) AS representative, count(*) AS aliases, arg_min(lang, doc_id) AS lang FROM documents GROUP BY 1")
def representative_argmin(spark, sf_dir):
    return C.representatives(read(spark, sf_dir, "documents"), F.col("text"), "doc_id", ["lang"])


@query("SELECT doc_id, sha256(text) AS content_hash, min(doc_id) OVER (PARTITION BY sha256(text)) AS canonical_doc_id FROM documents")
def content_dedup_aliases(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    return docs.join(docs.groupBy("content_hash").agg(F.min("doc_id").alias("canonical_doc_id")), "content_hash").select("doc_id", "content_hash", "canonical_doc_id")


@query("WITH k AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE doc_id % 2 = 0) SELECT count(*) AS inputs, count(k.h) AS cached, count(*) FILTER (WHERE k.h IS NULL) AS missing FROM documents d LEFT JOIN k ON sha256(d.text) = k.h")
def cache_coverage(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return C.cache_coverage(docs, docs.where("doc_id % 2 = 0"), "h")


@query("SELECT DISTINCT lang, source FROM documents")
def distinct_keys(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("lang", "source").distinct()


@query("SELECT d.doc_id, d.source FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_join_restriction(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents", "labels")
    return docs.select("doc_id", "source").join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi")


@query("SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS only_left, (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)) AS only_right, (SELECT count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)) AS both")
def set_equality_proof(spark, sf_dir):
    docs, labels = (t.select("doc_id").distinct() for t in read(spark, sf_dir, "documents", "labels"))
    both = docs.withColumn("l", F.lit(1)).join(labels.withColumn("r", F.lit(1)), "doc_id", "full")
    return both.agg(F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("both"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 AND doc_id % 3 = 0 THEN 'conflict' WHEN doc_id % 4 = 0 THEN 'browser' WHEN doc_id % 3 = 0 THEN 'legacy' ELSE 'retry' END AS bucket FROM documents")
def exhaustive_buckets(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id")
    browser = docs.where("doc_id % 4 = 0").withColumn("b", F.lit(True))
    legacy = docs.where("doc_id % 3 = 0").withColumn("g", F.lit(True))
    rows = docs.join(browser, "doc_id", "left").join(legacy, "doc_id", "left")
    return rows.select("doc_id", F.when(F.col("b") & F.col("g"), "conflict").when(F.col("b"), "browser").when(F.col("g"), "legacy").otherwise("retry").alias("bucket"))


@query("SELECT doc_id, CAST(('0x' || substr(sha256(text), 1, 8))::BIGINT % 7 AS INTEGER) AS worker FROM documents")
def task_modulo(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", C.modulo_worker(F.sha2("text", 256), 7).alias("worker"))


@query("WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents) SELECT CAST(position * 4 // (SELECT count(*) FROM documents) AS BIGINT) AS worker, min(doc_id) AS first, max(doc_id) AS last, count(*) AS n FROM p GROUP BY 1")
def contiguous_shards(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id")
    total = docs.agg(F.count("*").alias("total"))
    rows = C.positions(docs, "doc_id").crossJoin(F.broadcast(total))  # one row
    return rows.groupBy(F.floor(F.col("position") * 4 / F.col("total")).alias("worker")).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS requested, count(*) FILTER (WHERE value > 50) AS success, round(sum(value) FILTER (WHERE value > 50), 4) AS total, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1")
def health_by_group(spark, sf_dir):
    good, events = F.col("value") > 50, read(spark, sf_dir, "events")
    rows = events.groupBy("event_type").agg(F.count("*").alias("requested"), F.count_if(good).alias("success"), F.round(F.sum(F.when(good, F.col("value"))), 4).alias("total"))
    return rows.join(C.quantile_columns(events, ["event_type"], "value", {"p50": 0.5, "p95": 0.95}), "event_type", "left")


@query("SELECT m AS metric, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.05), 6) AS p05, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.95), 6) AS p95, round(quantile_cont(v, 0.99), 6) AS p99 FROM (SELECT 'price' AS m, l_extendedprice AS v FROM lineitem UNION ALL SELECT 'quantity', l_quantity FROM lineitem UNION ALL SELECT 'discount', l_discount FROM lineitem) GROUP BY 1")
def distribution_metrics(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount")).unpivot([], ["price", "quantity", "discount"], "metric", "v")
    mean = rows.groupBy("metric").agg(F.round(F.avg("v"), 6).alias("mean"))
    return mean.join(C.quantile_columns(rows, ["metric"], "v", {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}), "metric")


@query("SELECT lang, source, count(*) AS documents FROM documents GROUP BY 1, 2")
def group_counts(spark, sf_dir):
    return C.group_count(read(spark, sf_dir, "documents"), "lang", "source", name="documents")


@query("SELECT w AS flag, count(*) AS documents FROM (SELECT unnest(string_split(props, ',')) AS w FROM events) GROUP BY 1")
def flag_explode_counts(spark, sf_dir):
    return read(spark, sf_dir, "events").select(F.explode(F.split("props", ",")).alias("flag")).groupBy("flag").agg(F.count("*").alias("documents"))


@query("SELECT d.doc_id, count(l.doc_id) AS value FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.quality = 1 GROUP BY 1")
def children_per_doc(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents", "labels")
    n = labels.where("quality = 1").groupBy("doc_id").agg(F.count("*").alias("value"))
    return docs.select("doc_id").distinct().join(n, "doc_id", "left").na.fill(0, ["value"])


@query("WITH a AS (SELECT n_nationkey, n_name, n_regionkey FROM nation), c AS (SELECT c_nationkey AS k, count(*) AS customers, round(avg(c_acctbal), 4) AS balance FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1) SELECT a.n_name, coalesce(customers, 0) AS customers, balance, coalesce(suppliers, 0) AS suppliers FROM a LEFT JOIN c ON a.n_nationkey = c.k LEFT JOIN s ON a.n_nationkey = s.k")
def aggregate_then_join(spark, sf_dir):
    nation, customer, supplier = read(spark, sf_dir, "nation", "customer", "supplier")
    c = customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"), F.round(F.avg("c_acctbal"), 4).alias("balance"))
    s = supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    return nation.join(c, "n_nationkey", "left").join(s, "n_nationkey", "left").na.fill(0, ["customers", "suppliers"]).select("n_name", "customers", "balance", "suppliers")


@query("""WITH d AS (SELECT doc_id, lang, n_chars FROM documents), f AS (SELECT doc_id, 'first' AS why FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM d) WHERE rn <= 3),
    l AS (SELECT doc_id, 'longest' AS why FROM d ORDER BY n_chars DESC, doc_id LIMIT 5), s AS (SELECT doc_id, 'shortest' AS why FROM d ORDER BY n_chars, doc_id LIMIT 5)
    SELECT * FROM f UNION ALL SELECT * FROM l UNION ALL SELECT * FROM s""")
def audit_sample_extremes(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    parts = [C.first_per_group(d, 3, ["lang"], ["doc_id"]), d.orderBy(F.desc("n_chars"), "doc_id").limit(5), d.orderBy("n_chars", "doc_id").limit(5)]
    rows = [p.select("doc_id", F.lit(w).alias("why")) for p, w in zip(parts, ("first", "longest", "shortest"), strict=True)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 5")
def top_slice(spark, sf_dir):
    return C.group_count(read(spark, sf_dir, "documents"), "source", name="n").orderBy(F.desc("n"), "source").limit(5)


@query("SELECT lang, doc_id, ordinal FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS ordinal FROM documents) ORDER BY ordinal, lang, doc_id LIMIT 60")
def round_robin_pool(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars")
    w = Window.partitionBy("lang").orderBy("n_chars", "doc_id")
    return d.withColumn("ordinal", F.row_number().over(w)).where("ordinal <= 60").orderBy("ordinal", "lang", "doc_id").limit(60).select("lang", "doc_id", "ordinal")


@query("WITH n AS (SELECT lang AS metric, avg(n_chars) AS value FROM documents GROUP BY 1), b AS (SELECT lang AS metric, avg(n_chars) AS baseline FROM documents WHERE doc_id % 2 = 0 GROUP BY 1) SELECT n.metric, round(value, 6) AS value, round(baseline, 6) AS baseline, round((value - baseline) / abs(baseline), 6) AS change, abs((value - baseline) / abs(baseline)) > 0.02 AS warning FROM n JOIN b ON n.metric = b.metric")
def metric_drift(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    mean = lambda x: x.groupBy(F.col("lang").alias("metric")).agg(F.avg("n_chars").alias("value"))
    return C.drift(mean(d), mean(d.where("doc_id % 2 = 0")), "metric", "value", 0.02)


@query("SELECT user_id, CAST(CAST(ts + INTERVAL 7 HOUR AS DATE) AS VARCHAR) AS day, count(*) AS used, greatest(0, 3 - count(*)) AS left_today FROM events WHERE event_type = (SELECT min(event_type) FROM events) GROUP BY 1, 2")
def journal_budget(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    kind = e.agg(F.min("event_type").alias("event_type"))
    day = F.to_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "+07:00")).cast("string")
    return e.join(F.broadcast(kind), "event_type").groupBy("user_id", day.alias("day")).agg(F.count("*").alias("used"), F.greatest(F.lit(0), 3 - F.count("*")).alias("left_today"))


@query("SELECT event_id, json_valid(props) AS valid, json_extract_string(props, '$.k') AS k, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_number FROM events")
def json_probe(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    return read(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").isNotNull().alias("valid"), k.alias("k"), k.try_cast("bigint").alias("k_number"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'crawl' WHEN l_quantity > 45 THEN 'too_large' WHEN l_discount = 0 THEN 'empty' ELSE NULL END AS phase, CASE WHEN l_returnflag = 'R' THEN 'HTTP_' || l_linestatus WHEN l_quantity > 45 THEN 'SOURCE_TOO_LARGE' WHEN l_discount = 0 THEN 'EMPTY_CONTENT' ELSE NULL END AS reason FROM lineitem")
def hold_ladder(spark, sf_dir):
    from tessera.operators.intake import ladder

    rules = [(F.col("l_returnflag") == "R", "crawl", F.concat(F.lit("HTTP_"), "l_linestatus")), (F.col("l_quantity") > 45, "too_large", F.lit("SOURCE_TOO_LARGE")), (F.col("l_discount") == 0, "empty", F.lit("EMPTY_CONTENT"))]
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ladder(rules).alias("h")).select("l_orderkey", "l_linenumber", "h.phase", "h.reason")


@query("SELECT state, count(*) AS n FROM (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'NEEDS_RAW' WHEN l.quality = 1 THEN 'TEXT_READY' ELSE 'NEEDS_CRAWL' END AS state FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY 1")
def state_histogram(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents", "labels")
    state = F.when(F.col("quality").isNull(), "NEEDS_RAW").when(F.col("quality") == 1, "TEXT_READY").otherwise("NEEDS_CRAWL")
    return docs.select("doc_id").join(labels, "doc_id", "left").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


BINDING = """f AS (SELECT page_id AS id, url FROM pages), c AS (SELECT page_id AS id, url FROM pages WHERE page_id % 9 > 0 UNION ALL SELECT page_id, url FROM pages WHERE page_id % 50 = 1 UNION ALL SELECT page_id + 1000000, url FROM pages WHERE page_id % 40 = 3)"""


@query(f"""WITH {BINDING} SELECT 'duplicate_crawl' AS "check", (SELECT count(*) - count(DISTINCT id) FROM c) AS violations, true AS fatal
    UNION ALL SELECT 'duplicate_frontier', (SELECT count(*) - count(DISTINCT id) FROM f), true
    UNION ALL SELECT 'frontier_missing_crawl', (SELECT count(*) FROM f WHERE id NOT IN (SELECT id FROM c)), false
    UNION ALL SELECT 'crawl_outside_frontier', (SELECT count(*) FROM c WHERE id NOT IN (SELECT id FROM f)), true
    UNION ALL SELECT 'frontier_crawl_url_mismatch', (SELECT count(*) FROM f JOIN c ON f.id = c.id WHERE f.url IS DISTINCT FROM c.url), true""")
def binding_audit(spark, sf_dir):
    from tessera.operators.intake import binding_checks

    f = read(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    c = f.where("id % 9 > 0").unionByName(f.where("id % 50 = 1")).unionByName(f.where("id % 40 = 3").withColumn("id", F.col("id") + 1000000))
    return binding_checks(f, c, "id", "url")


@query("SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'IMPORTED' WHEN l.quality = 0 THEN 'HELD' ELSE 'PENDING' END AS state, CASE WHEN l.quality = 0 THEN 'LOW_QUALITY' END AS reason_code FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def outcome_states(spark, sf_dir):
    from tessera.operators.intake import outcomes

    docs, labels = read(spark, sf_dir, "documents", "labels")
    held = labels.where("quality = 0").select("doc_id", F.lit("LOW_QUALITY").alias("reason_code"))
    return outcomes(docs.select("doc_id"), labels.where("quality = 1").select("doc_id"), held, "doc_id")
