"""Output replay: parents of another size for hits that are already ranked, merged under a cap, and the
sweep of sizes over an evaluation.

Each document that has hits is tokenised once; what a variant needs are places of tokens. A variant is
(parent tokens, cap or none). Its parents are ranges of tokens around the hit inside the hit's section.
With a cap, the hits of a query are taken in order of rank, and each joins the first group of its
document and section that it overlaps or touches, if together they stay within the cap; else it opens a
group. A group grows as hits join, so what a hit meets hangs on those before it: that is a fold over a
query's ranked list, which is as short as the ranking's cutoff made it.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import passages, spans
from tessera.session import materialise, sent_if_few, ship_package

#: (parent tokens, merge cap): sizes alone, then the usual size with merging.
VARIANTS = ((256, None), (384, None), (512, None), (640, None), (768, None), (512, 768))


def named(parent: int, cap: int | None) -> str:
    return f"parent-{parent}" + (f"-merge-{cap}" if cap else "")


_SPAN = "struct<variant:string,first:int,last:int,start_char:int,end_char:int>"


def parents(hits: DataFrame, docs: DataFrame, doc: str, text: str, chunk: str = "chunk_order", variants=VARIANTS, size: int = 180, overlap: int = 40, headings: tuple[str, ...] = (), tokenizer=None) -> DataFrame:
    """One row for each hit and variant: the columns of hits, variant, section, first, last (tokens of the
    parent), start_char, end_char. hits name children by their order in the document, as `chunked`
    numbers them; a hit whose child does not exist, or is larger than a variant's parent, is an error."""
    ship_package(docs.sparkSession)
    tokenizer, known = tokenizer or spans.WordTokenizer(), frozenset(headings)

    def of(text_: str, orders) -> list[dict]:
        layout = passages.Layout(text_, tokenizer, known)
        kids, out = passages.children(layout, size, overlap), []
        for order in orders:
            child = kids[order]
            for tokens, cap in variants:
                if child[2] - child[1] > tokens:
                    raise ValueError(f"a parent of {tokens} tokens cannot hold its child")
                a, b = passages.parent(layout, child, tokens)
                out.append({"chunk": order, "section": child[0], "span": {"variant": named(tokens, cap), "first": a, "last": b, "start_char": layout.starts[a], "end_char": layout.ends[b - 1]}})
        return out

    @F.pandas_udf(f"array<struct<chunk:int,section:int,span:{_SPAN}>>")
    def find(texts: pd.Series, orders: pd.Series) -> pd.Series:
        return pd.Series([of(t, list(o)) for t, o in zip(texts, orders, strict=True)])

    wanted = hits.groupBy(doc).agg(F.array_sort(F.collect_set(F.col(chunk).cast("int"))).alias("orders"))  # one tokenisation a document
    found = docs.select(doc, F.col(text).alias("t")).join(sent_if_few(wanted, hits), doc).select(doc, F.explode(find("t", "orders")).alias("s"))
    found = found.select(doc, F.col("s.chunk").alias(chunk), F.col("s.section").alias("section"), "s.span.*")
    return hits.withColumn(chunk, F.col(chunk).cast("int")).join(found, [doc, chunk])


def fold(rows: list[tuple], cap: int) -> list[tuple[int, int, int, int, int]]:
    """rows: (doc, section, first, last, start, end) in order of rank. For each row, the number of its
    group and the group's final range (first, last, start, end)."""
    groups: list[list] = []
    own = []
    for doc, section, first, last, start, end in rows:
        for number, g in enumerate(groups):
            if section is None or g[:2] != [doc, section] or max(g[4], start) > min(g[5], end):
                continue
            if max(g[3], last) - min(g[2], first) <= cap:
                g[2:] = [min(g[2], first), max(g[3], last), min(g[4], start), max(g[5], end)]
                own.append(number)
                break
        else:
            own.append(len(groups))
            groups.append([doc, section, first, last, start, end])
    return [(number, *groups[number][2:]) for number in own]


def merged(rows: DataFrame, query: str, doc: str, rank: str, variants=VARIANTS) -> DataFrame:
    """The rows of `parents` with `parent`, the number of the row's parent among those of its query and
    variant, and the parent's range after merging. Without a cap every hit keeps its own range."""
    caps = {named(t, c): c for t, c in variants if c}
    plain = rows.where(~F.col("variant").isin(list(caps))).withColumn("parent", (F.row_number().over(Window.partitionBy("variant", query).orderBy(rank, doc)) - 1).cast("int"))
    if not caps:
        return plain
    columns = ["first", "last", "start_char", "end_char", "parent"]
    names = rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", parent int"

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(rank, "ascending"), (doc, "ascending")])
        cap = caps[group.column("variant")[0].as_py()]
        got = fold(list(zip(*[group.column(c).to_pylist() for c in (doc, "section", "first", "last", "start_char", "end_char")], strict=True)), cap)
        group = group.drop_columns(columns[:4])
        for name, values in zip(["parent", *columns[:4]], zip(*got, strict=True), strict=True):
            group = group.append_column(name, pa.array(values, pa.int32()))
        return group.select([*names, "parent"])

    capped = rows.where(F.col("variant").isin(list(caps))).groupBy("variant", query).applyInArrow(run, schema)
    return plain.unionByName(capped)


def sweep(hits: DataFrame, docs: DataFrame, gold: DataFrame, query: str, doc: str, text: str, rank: str = "rank", variants=VARIANTS, per_doc: int = 2, most: int = 8, threshold: float = 0.8, **layout) -> DataFrame:
    """(variant, queries, document_f2, chunk_f2, combined_f2, place): the variants in order of the mean of
    both metrics, then of smaller parents, over queries that have gold rows (query, doc, tokens)."""
    from tessera.operators import evaluation, retrieval

    spark = hits.sparkSession
    ranges = merged(parents(hits, docs, doc, text, variants=variants, **layout), query, doc, rank, variants)
    ranges = materialise(ranges.groupBy("variant", query, doc, "parent", "start_char", "end_char").agg(F.min(rank).alias(rank)), "replay")
    from tessera.functions.text import words as tokens_of

    source = docs.select(doc, F.col(text).alias("t"))
    ranges = ranges.withColumn("asked", F.concat_ws("\x1f", "variant", F.col(query).cast("string")))
    with_text = lambda rows: rows.join(source, doc).withColumn("text", F.expr("substring(t, start_char + 1, end_char - start_char)")).drop("t")
    chosen = retrieval.select_passages(with_text(ranges), "asked", doc, "parent", tokens_of(F.col("text")), rank, per_doc, most, threshold)
    chosen = materialise(chosen.select("asked", doc, "parent", "place"), "replay")
    # texts are read again for what was chosen alone
    kept = materialise(with_text(ranges.join(chosen, ["asked", doc, "parent"])).withColumn("tokens", tokens_of(F.col("text"))).drop("text", "start_char", "end_char"), "replay")
    names = spark.createDataFrame([(named(t, c), t, c or 0) for t, c in variants], "variant string, size int, cap int")
    wanted = gold.join(F.broadcast(names.select("variant")), how="cross").withColumn("asked", F.concat_ws("\x1f", "variant", F.col(query).cast("string")))  # a handful of variants
    by_chunk = evaluation.chunk_metrics(kept, wanted, "asked", doc, "tokens").select("asked", F.col("f2").alias("chunk"))
    by_doc = evaluation.document_metrics(kept.select("asked", doc).distinct(), wanted.select("asked", doc).distinct(), "asked", doc).select("asked", F.col("f2").alias("document"))
    each = wanted.select("asked", "variant").distinct().join(by_doc, "asked", "left").join(by_chunk, "asked", "left")
    mean = each.groupBy("variant").agg(F.count("*").alias("queries"), F.avg(F.coalesce("document", F.lit(0.0))).alias("document_f2"), F.avg(F.coalesce("chunk", F.lit(0.0))).alias("chunk_f2"))
    mean = mean.join(names, "variant").withColumn("combined_f2", (F.col("document_f2") + F.col("chunk_f2")) / 2)
    place = F.row_number().over(Window.orderBy(F.desc(F.round("combined_f2", 12)), "size", "cap"))  # as many rows as variants
    rounded = [F.round(c, 6).alias(c) for c in ("document_f2", "chunk_f2", "combined_f2")]
    return mean.withColumn("place", place).select("variant", "queries", *rounded, "place")
