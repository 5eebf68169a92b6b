"""Intake: ladders of reasons, binding audits, conservation of outcomes, and work packing."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ladder(rules: list[tuple[Column, str, Column]]) -> Column:
    """The first rule that holds, as a struct (phase, reason); null where none does."""
    out = None
    for test, phase, reason in rules:
        value = F.struct(F.lit(phase).alias("phase"), reason.cast("string").alias("reason"))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def binding_checks(frontier: DataFrame, crawl: DataFrame, key: str, url: str) -> DataFrame:
    """(check, violations, fatal): gaps in coverage are not fatal, broken identities are."""
    c = crawl.select(F.col(key).alias("c_key"), F.col(url).alias("c_url"))
    count = lambda df: df.agg(F.count("*").alias("violations"))
    dup = lambda df: df.agg((F.count("*") - F.count_distinct(key)).alias("violations"))
    checks = [
        ("duplicate_crawl", dup(crawl), True),
        ("duplicate_frontier", dup(frontier), True),
        ("frontier_missing_crawl", count(frontier.join(crawl.select(key).distinct(), key, "left_anti")), False),
        ("crawl_outside_frontier", count(crawl.join(frontier.select(key).distinct(), key, "left_anti")), True),
        ("frontier_crawl_url_mismatch", count(frontier.join(c, F.col(key) == F.col("c_key")).where(~F.col(url).eqNullSafe(F.col("c_url")))), True),
    ]
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("check"), "violations", F.lit(f).alias("fatal")) for n, df, f in checks])


def outcomes(inputs: DataFrame, imported: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """(key, state, reason_code): every input once, imported before held before pending."""
    i = imported.select(key).distinct().withColumn("__i", F.lit(True))
    h = held.groupBy(key).agg(F.min("reason_code").alias("reason_code"), F.lit(True).alias("__h"))
    rows = inputs.join(i, key, "left").join(h, key, "left")
    state = F.when(F.col("__i"), "IMPORTED").when(F.col("__h"), "HELD").otherwise("PENDING")
    return rows.select(key, state.alias("state"), F.when(F.col("__i").isNull(), F.col("reason_code")).alias("reason_code"))


def pack_by_budget(tasks: DataFrame, worker: str, key: str, size: str, budget: int) -> DataFrame:
    """(worker, key, taken): each worker's tasks in order of key, skipping what no longer fits its
    budget. A fold over one worker's list; workers run side by side."""
    schema = ", ".join(f"{c} {tasks.schema[c].dataType.simpleString()}" for c in (worker, key)) + ", taken boolean"

    def fold(g: pd.DataFrame) -> pd.DataFrame:
        g, left, taken = g.sort_values(key), budget, []
        for n in g[size]:
            taken.append(n <= left)
            left -= n if n <= left else 0
        return pd.DataFrame({worker: g[worker], key: g[key], "taken": taken})

    return tasks.groupBy(worker).applyInPandas(fold, schema)


def token_batches(rows: DataFrame, group: str, key: str, length: str, budget: int) -> DataFrame:
    """(group, key, batch): rows by length, cut where members times the longest passes the budget."""
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (group, key)) + ", batch int"

    def fold(g: pd.DataFrame) -> pd.DataFrame:
        g, batch, n, out = g.sort_values([length, key]), 0, 0, []
        for size in g[length]:
            if n and (n + 1) * size > budget:
                batch, n = batch + 1, 0
            n += 1
            out.append(batch)
        return pd.DataFrame({group: g[group], key: g[key], "batch": out})

    return rows.groupBy(group).applyInPandas(fold, schema)


def source_problem(status: Column, size: Column, digest: Column, body: Column) -> Column:
    """Why a raw record cannot be used; null if it can."""
    return (
        F.when(status.isNull() | (status != "SUCCESS_RAW"), "NOT_SUCCESSFUL")
        .when(body.isNull(), "BODY_MISSING")
        .when(F.octet_length(body) != size, "SIZE_MISMATCH")
        .when(~digest.eqNullSafe(F.sha2(body, 256)), "HASH_MISMATCH")
    )


def extraction_checks(frontier: DataFrame, crawl: DataFrame, extracted: DataFrame, official: DataFrame) -> DataFrame:
    """(check, violations, fatal) of an extraction against what it was made from; a missing extraction
    is a gap, everything else is fatal.

    frontier(id, url, alias_count, snapshot), crawl(id, url, ok), extracted(id, url, text,
    source_chars, snapshot), official(official_id, url): official links meet the frontier by url.
    """
    count = lambda df: df.agg(F.count("*").alias("violations"))
    dup = lambda df, k: df.agg((F.count("*") - F.count_distinct(k)).alias("violations"))
    fetched = crawl.where("ok").select("id", F.col("url").alias("c_url")).distinct()
    bound = extracted.join(fetched, "id", "left")
    mapped = official.groupBy("url").agg(F.count("*").alias("mapped"))
    known = frontier.select("id", F.col("snapshot").alias("f_snapshot")).distinct()
    checks = [
        ("duplicate_extracted", dup(extracted, "id"), True),
        ("invalid_extraction_binding", count(bound.where(~F.col("url").eqNullSafe(F.col("c_url")))), True),
        ("missing_extraction", count(fetched.join(extracted.select("id").distinct(), "id", "left_anti")), False),
        ("invalid_source_length", count(extracted.where(~F.col("source_chars").eqNullSafe(F.length("text")) | (F.length("text") == 0))), True),
        ("unmapped_frontier_or_alias_mismatch", count(frontier.join(mapped, "url", "left").where(~F.col("alias_count").eqNullSafe(F.col("mapped")))), True),
        ("duplicate_official_id", dup(official, "official_id"), True),
        ("snapshot_binding_mismatch", count(extracted.join(known, "id").where(~F.col("snapshot").eqNullSafe(F.col("f_snapshot")))), True),
    ]
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("check"), "violations", F.lit(f).alias("fatal")) for n, df, f in checks])
