"""Audits: retained crawls before they are reused, exclusion of documents, and what an evaluation is made of."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import urls as U
from tessera.operators import evaluation


def exclusion_reason(title: Column, text: Column, requested: Column, final: Column) -> Column:
    """Why a document is kept out of retrieval, null if it is not: a payload in its text outweighs a
    redirect to the site's root, which outweighs the title of an error page. A null in any column
    decides nothing."""
    payload = F.coalesce(T.has_encoded_payload(text), F.lit(False))
    home = F.coalesce(U.redirected_home(requested, final), F.lit(False))
    page = T.error_page_reason(F.coalesce(title, F.lit("")), F.coalesce(text, F.lit("")))
    return F.when(payload, "ENCODED_PAYLOAD_REVIEW").when(home, "ARTICLE_REDIRECTED_TO_HOMEPAGE").otherwise(page)


def _flags(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """(check, violations) of tests on the rows of one table, all in one pass."""
    return df.agg(*[c.cast("long").alias(n) for n, c in tests.items()]).unpivot([], list(tests), "check", "violations")


def _counts(tables: dict[str, DataFrame]) -> list[DataFrame]:
    return [df.agg(F.count("*").alias("violations")).select(F.lit(n).alias("check"), "violations") for n, df in tables.items()]


def _repeats(key: str) -> Column:
    return F.count("*") - F.count_distinct(key)


def _fails(sound: Column) -> Column:
    """Rows that a test does not hold for; an unknown is a failure."""
    return F.count_if(~F.coalesce(sound, F.lit(False)))


def retained_crawl(mapping: DataFrame, raw: DataFrame, official: DataFrame, existing: DataFrame, snapshot: str, original: str) -> DataFrame:
    """(check, violations) of a crawl that is to be used again, before anything is read from it.

    mapping(doc_id, crawl_url_id, original_url), raw(crawl_url_id, fetch_url, raw_path, raw_sha256,
    raw_size_bytes, original_crawl_record_json, original_snapshot_id, new_snapshot_id), official(id,
    url), existing(doc_id, url). A locator must stay below `raw/`; the record kept from the crawl
    must be JSON that says what the row says.
    """
    said = lambda field: F.get_json_object("original_crawl_record_json", f"$.{field}")
    path = F.col("raw_path")
    alone = _flags(raw, {
        "duplicate_raw_id": _repeats("crawl_url_id"),
        "invalid_raw_locator": _fails(path.startswith("raw/") & ~path.contains("..") & ~path.contains("\\")),
        "invalid_raw_metadata": _fails(F.col("raw_sha256").rlike(r"\A[0-9a-f]{64}\z") & (F.col("raw_size_bytes") > 0)),
        "invalid_original_crawl": _fails((said("status") == "SUCCESS_RAW") & said("snapshot_id").eqNullSafe(F.col("original_snapshot_id")) & said("raw_sha256").eqNullSafe(F.col("raw_sha256")) & said("fetch_url").eqNullSafe(F.col("fetch_url"))),
        "snapshot_mismatch": _fails((F.col("new_snapshot_id") == snapshot) & (F.col("original_snapshot_id") == original)),
    })
    m = mapping.select("doc_id", "crawl_url_id", F.col("original_url").alias("url"))
    keys = raw.select("crawl_url_id", F.col("fetch_url").alias("fetched"))
    links = official.select(F.col("id").alias("doc_id"), "url")
    aliases = links.withColumn("fetched", U.fetch_url(F.col("url"))).join(keys.select("fetched"), "fetched")
    known = existing.select("doc_id", F.col("url").alias("known_url"))
    between = _counts({
        "unmapped_native_id": m.join(links, ["doc_id", "url"], "left_anti"),
        "mapping_missing_raw": m.join(keys, "crawl_url_id", "left_anti"),
        "raw_outside_mapping": keys.join(m, "crawl_url_id", "left_anti"),
        "native_url_conflict": m.join(known, "doc_id").where(~F.col("url").eqNullSafe(F.col("known_url"))),
        "fetch_url_mismatch": m.join(keys, "crawl_url_id").where(~U.fetch_url(F.col("url")).eqNullSafe(F.col("fetched"))),
        "missing_official_alias": aliases.join(m, ["doc_id", "url"], "left_anti"),
    })
    return reduce(DataFrame.unionByName, [_flags(mapping, {"duplicate_mapping_id": _repeats("doc_id")}), alone, *between])


def retained_extraction(raw: DataFrame, extracted: DataFrame) -> DataFrame:
    """(check, violations) of the texts that were extracted from a retained crawl.

    raw(crawl_url_id, raw_sha256, original_snapshot_id, extract_status), extracted(crawl_url_id,
    snapshot_id, raw_sha256, extract_status, text, char_count).
    """
    text = F.col("text")
    alone = _flags(extracted, {
        "duplicate_extraction": _repeats("crawl_url_id"),
        "invalid_source_length": _fails((F.length(F.trim(text)) > 0) & (F.col("char_count") == F.length(text))),
    })
    source = raw.select("crawl_url_id", F.struct(F.col("original_snapshot_id").alias("snapshot_id"), "raw_sha256", "extract_status").alias("source"))
    bound = extracted.join(source, "crawl_url_id", "left")
    sound = F.col("source").eqNullSafe(F.struct("snapshot_id", "raw_sha256", "extract_status")) & (F.col("extract_status") == "EXTRACT_SUCCESS")
    between = _counts({
        "extraction_binding": bound.where(~F.coalesce(sound, F.lit(False))),
        "missing_successful_extraction": raw.where("extract_status = 'EXTRACT_SUCCESS'").join(extracted, "crawl_url_id", "left_anti"),
    })
    return reduce(DataFrame.unionByName, [alone, *between])


def sliced(metrics: DataFrame, slices: DataFrame, query_key: str, digits: int = 6) -> DataFrame:
    """(slice, value, queries, precision, recall, f2): macro means over the queries of each value of
    each slice. slices(query_key, slice, value); a query counts once for each value that it has."""
    rows = metrics.join(slices.select(query_key, "slice", "value").distinct(), query_key)
    return rows.groupBy("slice", "value").agg(F.count("*").alias("queries"), *[F.round(F.avg(c), digits).alias(c) for c in ("precision", "recall", "f2")])


def slice_gate(before: DataFrame, after: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """(slice, value, change, passed) of two results of `sliced`: a slice passes if its F2 fell by no
    more than the tolerance; one that only one side has does not."""
    b = before.select("slice", "value", F.col("f2").alias("b"))
    a = after.select("slice", "value", F.col("f2").alias("a"))
    change = F.round(F.col("a") - F.col("b"), 6)
    return b.join(a, ["slice", "value"], "full").select("slice", "value", change.alias("change"), F.coalesce(change >= -tolerance, F.lit(False)).alias("passed"))


def ablations(legs: DataFrame, variants: dict[str, dict[str, float]], gold: DataFrame, query_key: str, key: str, k: int, base: str, offset: int = 60) -> DataFrame:
    """(variant, queries, precision, recall, f2, change) of fusing the legs (query_key, key, branch,
    rank) with each variant's weights and keeping k; a branch without weight is not in the variant.

    All variants are judged from one reading of the legs: each leg's rows meet the variants that use
    it, so rows grow with the number of variants, a list of the caller. change is against `base`.
    """
    spark = legs.sparkSession
    grid = spark.createDataFrame([(v, b, float(w)) for v, ws in variants.items() for b, w in ws.items() if w > 0], "variant string, branch string, weight double")
    score = F.round(F.sum(F.col("weight") / (offset + F.col("rank"))), 6)
    fused = legs.join(grid, "branch").groupBy("variant", query_key, key).agg(score.alias("score"))
    place = F.row_number().over(Window.partitionBy("variant", query_key).orderBy(F.desc("score"), key))
    kept = fused.withColumn("place", place).where(F.col("place") <= k)
    g = gold.select(query_key, key).distinct()
    names = spark.createDataFrame([(v,) for v in variants], "variant string")
    asked = g.groupBy(query_key).agg(F.count("*").alias("ng")).crossJoin(names)  # one row a variant
    hits = kept.join(g.withColumn("hit", F.lit(1)), [query_key, key], "left").groupBy("variant", query_key).agg(F.count("*").alias("np"), F.count("hit").alias("hits"))
    rows = asked.join(hits, ["variant", query_key], "left").na.fill(0, ["np", "hits"])
    precision, recall = F.when(F.col("np") > 0, F.col("hits") / F.col("np")).otherwise(0.0), F.col("hits") / F.col("ng")
    rows = rows.withColumns({"precision": precision, "recall": recall}).withColumn("f2", evaluation.f2(F.col("precision"), F.col("recall")))
    done = rows.groupBy("variant").agg(F.count("*").alias("queries"), *[F.avg(c).alias(c) for c in ("precision", "recall", "f2")])
    own = F.max(F.when(F.col("variant") == base, F.col("f2"))).over(Window.partitionBy())  # one row a variant
    done = done.withColumn("change", F.col("f2") - own)
    return done.select("variant", "queries", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f2", "change")])
