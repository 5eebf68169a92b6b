"""Second-stage ranking, query checks, passages, sweeps and label rules."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import evaluation, retrieval


def documents_of_hits(hits: DataFrame, units: DataFrame, children: DataFrame, query_key: str) -> DataFrame:
    """(query_key, doc_id, score): hits on positions, to units, to the children that share a unit, to
    the best score of each document."""
    rows = hits.join(units, "position").join(children, "unit_id")
    return retrieval.max_per_document(rows, [query_key, "doc_id"])


def child_fusion(orders: DataFrame, query_key: str, doc: str, child: str, weights: dict[str, float], offset: int = 60, global_rank: str | None = None) -> DataFrame:
    """Reciprocal-rank fusion of children within each document; with global_rank, a column, half a
    vote more for a child's rank over all documents."""
    weight = F.create_map(*[x for b, w in weights.items() for x in (F.lit(b), F.lit(float(w)))])
    part = F.sum(weight[F.col("branch")] / (offset + F.col("rank")))
    bonus = F.coalesce(F.max(0.5 / (offset + F.col(global_rank))), F.lit(0.0)) if global_rank else F.lit(0.0)
    return orders.groupBy(query_key, doc, child).agg((part + bonus).alias("score"))


def baseline_ranking(doc_scores: DataFrame, child_scores: DataFrame, query_key: str, doc: str, child: str, per_doc: int = 5) -> DataFrame:
    """Children by document score plus own score, at most per_doc of a document, with their place."""
    both = child_scores.join(doc_scores.withColumnRenamed("score", "__d"), [query_key, doc]).withColumn("score", F.round(F.col("score") + F.col("__d"), 9)).drop("__d")
    w = Window.partitionBy(query_key, doc).orderBy(F.desc("score"), child)
    few = both.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= per_doc).drop("__rn")
    return few.withColumn("place", F.row_number().over(Window.partitionBy(query_key).orderBy(F.desc("score"), child)))


def rerank(rows: DataFrame, query_key: str, key: str, model: str, score: str, share: float | None = None, offset: int = 60) -> DataFrame:
    """Order by the model's score, then the retrieval score, then the key; with `share`, by fusion of
    both orders, the model's of that weight."""
    w = Window.partitionBy(query_key)
    m, r = F.row_number().over(w.orderBy(F.desc(model), F.desc(score), key)), F.row_number().over(w.orderBy(F.desc(score), key))
    if share is None:
        return rows.withColumn("place", m)
    fused = rows.withColumn("__m", m).withColumn("__r", r).withColumn("__f", F.round(share / (offset + F.col("__m")) + (1 - share) / (offset + F.col("__r")), 12))
    return fused.withColumn("place", F.row_number().over(w.orderBy(F.desc("__f"), key))).drop("__m", "__r", "__f")


def mining_fusion(docs: DataFrame, children: DataFrame, query_key: str, doc: str, child: str, offset: int = 60) -> DataFrame:
    """A child scores 1/(k + rank of its document) + 1/(k + own rank)."""
    d = docs.select(query_key, doc, F.col("rank").alias("__d"))
    return children.join(d, [query_key, doc]).select(query_key, doc, child, (1 / (offset + F.col("__d")) + 1 / (offset + F.col("rank"))).alias("score"))


def suppress_overlaps(spans: DataFrame, query_key: str, doc: str, start: str, end: str, order: str, per_doc: int, most: int, overlap: float = 0.8) -> DataFrame:
    """Spans in order, without one whose characters overlap an earlier one of its document by
    `overlap` of their union; the group is one query's bounded candidate list."""
    names = [query_key, doc, start, end]
    wanted = list(dict.fromkeys([*names, order]))
    once = list(dict.fromkeys(names))
    schema = ", ".join(f"{c} {spans.schema[c].dataType.simpleString()}" for c in once) + ", place int"

    def pick(batches):
        """Rows come sorted by query and in order: what is kept of one query is held at a time."""
        begun, current, held, place = False, None, {}, 0
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in once}
            keep, places = [], []
            for i, (q, d, a, b) in enumerate(zip(*[columns[c] for c in names], strict=True)):
                if not begun or q != current:
                    begun, current, held, place = True, q, {}, 0
                mates = held.get(d, ())
                if place >= most or len(mates) >= per_doc or any(max(0, min(b, y) - max(a, x)) >= overlap * (max(b, y) - min(a, x)) for x, y in mates):
                    continue
                held.setdefault(d, []).append((a, b))
                place += 1
                keep.append(i)
                places.append(place)
            kept = batch.select(once).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(places, pa.int32())], names=[*once, "place"])

    dealt = spans.select(*wanted).repartition(query_key).sortWithinPartitions(query_key, order, doc, start)
    return dealt.mapInArrow(pick, schema)


def centred_parents(children: DataFrame, docs: DataFrame, doc: str, text: str, width: int) -> DataFrame:
    """A parent of at most `width` characters around each child, inside the text, its ends moved
    inwards to the nearest line ends that leave the child whole. Native."""
    rows = children.join(docs.select(doc, F.col(text).alias("__t")), doc)
    room = F.greatest(F.lit(0), width - (F.col("end_char") - F.col("start_char")))
    left = F.greatest(F.lit(0), F.col("start_char") - F.floor(room / 2).cast("int"))
    right = F.least(F.length("__t"), F.col("end_char") + (room - F.floor(room / 2).cast("int")))
    rows = rows.withColumns({"__a": left, "__b": right})
    head = F.substring("__t", F.col("__a") + 1, F.col("start_char") - F.col("__a"))
    tail = F.substring("__t", F.col("end_char") + 1, F.col("__b") - F.col("end_char"))
    snapped_left = F.when((F.col("__a") > 0) & (F.locate("\n", head) > 0), F.col("__a") + F.locate("\n", head)).otherwise(F.col("__a"))
    back = F.locate("\n", F.reverse(tail))
    snapped_right = F.when((F.col("__b") < F.length("__t")) & (back > 0), F.col("__b") - back).otherwise(F.col("__b"))
    rows = rows.withColumn("parent_start", snapped_left.cast("int")).withColumn("parent_end", snapped_right.cast("int"))
    return rows.withColumn("parent_text", F.substring("__t", F.col("parent_start") + 1, F.col("parent_end") - F.col("parent_start"))).drop("__t", "__a", "__b")


def dense_text(title: Column, heading: Column, body: Column, most: int | None = None) -> Column:
    """Distinct title and heading before the body; the prefix is halved until all fits `most` words."""
    prefix = F.array_distinct(F.filter(F.array(F.trim(title), F.trim(heading)), lambda x: x.isNotNull() & (x != "")))
    whole = lambda p: F.concat_ws("\n\n", F.filter(F.array(p, body), lambda x: x != ""))
    joined = F.concat_ws("\n\n", prefix)
    if most is None:
        return whole(joined)
    words = lambda x: F.size(F.filter(F.split(x, r"\s+"), lambda y: y != ""))
    halves = [F.substring(joined, F.lit(1), F.floor(F.length(joined) / (1 << i)).cast("int")) for i in range(8)]
    return F.coalesce(*[F.when(words(whole(h)) <= most, whole(h)) for h in halves], body)


def passage_windows(tokens: Column, size: int, overlap: int) -> Column:
    """Overlapping windows (start, end) over a token array; the last ends at its end."""
    n, step = F.size(tokens), size - overlap
    count = F.greatest(F.lit(1), F.ceil((n - overlap) / step)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct((i * step).alias("start"), F.least(i * step + size, n).alias("end")))


def is_complex(query: Column, least: int = 120) -> Column:
    """A long query that joins several conditions."""
    return (F.length(query) >= least) & query.rlike(r"(?i)[,;:]|\b(?:and|or|with|without|und|et|y|con)\b")


def variant_problems(original: Column, variant: Column, protected: Column) -> Column:
    """Why a rewritten query must not be used: empty, other numbers or comparators, a protected term
    lost. An array of codes, empty if it may be used."""
    numbers = lambda q: F.array_sort(F.regexp_extract_all(q, F.lit(r"\d+(?:[.,]\d+)?|[<>≤≥]=?"), F.lit(0)))
    lost = F.exists(protected, lambda t: T.fold(original).contains(T.fold(t)) & ~T.fold(variant).contains(T.fold(t)))
    return F.array_compact(F.array(F.when(F.trim(F.coalesce(variant, F.lit(""))) == "", "EMPTY"), F.when(numbers(original) != numbers(variant), "NUMBERS_CHANGED"), F.when(lost, "PROTECTED_TERM_LOST")))


def expansion_problems(raw: Column, query: Column) -> Column:
    """Why a JSON expansion {subqueries, passage} must not be used; an array of codes."""
    e = F.from_json(raw, "subqueries array<string>, passage string")
    words = F.size(F.filter(F.split(e["passage"], r"\s+"), lambda w: w != ""))
    stray = F.exists(F.coalesce(e["subqueries"], F.array().cast("array<string>")), lambda s: F.size(F.array_intersect(T.words(s), T.words(query))) == 0)
    return F.array_compact(F.array(F.when(e["subqueries"].isNull() & e["passage"].isNull(), "NOT_JSON"), F.when(F.size(e["subqueries"]) > 2, "TOO_MANY"), F.when(words > 100, "PASSAGE_TOO_LONG"), F.when(stray, "NO_ANCHOR")))


def first_of_each(units: DataFrame, key: Column, ordinal: str, carry: list[str]) -> DataFrame:
    """One row a content, the first by ordinal."""
    row = F.min_by(F.struct(*carry), F.col(ordinal))
    return units.groupBy(F.sha2(key, 256).alias("content_hash")).agg(F.min(ordinal).alias(ordinal), row.alias("r")).select("content_hash", ordinal, *[F.col("r")[c].alias(c) for c in carry])


def cutoff_sweep(ranking: DataFrame, gold: DataFrame, query_key: str, key: str, grid: list[dict], digits: int = 6) -> DataFrame:
    """(setting, minimum, maximum, margin, floor, f2, size) of every cutoff of a grid, best first and
    smaller first among equals. All settings are judged in one pass over the ranking, whose lists are as
    short as its cutoff made them: a row is a query with its list, and settings multiply rows, not places."""
    spark = ranking.sparkSession
    kinds = "setting int, minimum int, maximum int, margin double, floor double"
    settings = spark.createDataFrame([(i, g["minimum"], g["maximum"], g.get("margin"), g.get("floor")) for i, g in enumerate(grid)], kinds)
    g = evaluation.gold_of(gold, query_key, key)
    one = F.struct("rank", "score", F.col("__hit").alias("hit"))
    lists = g.mark(ranking.select(query_key, key, "rank", "score")).groupBy(query_key).agg(F.array_sort(F.collect_list(one)).alias("list"), F.max("score").alias("top"))
    lists = lists.join(g.sizes(), query_key, "full").withColumn("list", F.coalesce("list", F.array().cast(lists.schema["list"].dataType)))
    each = lists.crossJoin(F.broadcast(settings))  # the grid is a list of the caller; a query's list is a row
    passed = lambda x: F.coalesce(x["score"] >= F.col("floor"), F.lit(True)) & F.coalesce(x["score"] >= F.col("top") - F.col("margin"), F.lit(True))
    kept = F.slice(F.filter("list", lambda x, i: (i < F.col("minimum")) | passed(x)), F.lit(1), F.col("maximum"))
    each = each.select("setting", "ng", F.transform(kept, lambda x: x["hit"]).alias("hit"))
    rows = each.select("setting", "ng", F.size("hit").alias("np"), F.size(F.array_compact("hit")).alias("hits"))
    precision, recall = F.when(F.col("np") > 0, F.col("hits") / F.col("np")).otherwise(0.0), F.col("hits") / F.col("ng")
    found = F.when(F.col("ng").isNotNull(), evaluation.f2(precision, recall))
    judged = rows.groupBy("setting").agg(F.round(F.avg(found), digits).alias("f2"), F.sum("np").alias("size"))
    return settings.join(judged.where("f2 IS NOT NULL"), "setting").orderBy(F.desc("f2"), "size", "setting")


def rerank_text(title: Column, children: Column, budget: int) -> Column:
    """The title and, in order, the first words of each child: what the title leaves of the budget of
    words, in equal shares."""
    words = lambda t: F.filter(F.split(t, r"\s+"), lambda w: w != "")
    share = F.greatest(F.lit(0), F.floor((budget - F.size(words(title))) / F.greatest(F.size(children), F.lit(1)))).cast("int")
    heads = F.transform(children, lambda c: F.concat_ws(" ", F.slice(words(c), F.lit(1), share)))
    return F.concat_ws("\n", F.filter(F.concat(F.array(title), heads), lambda x: x != ""))


def stage_recall(gold: DataFrame, stages: dict[str, DataFrame], query_key: str, key: str, digits: int = 6) -> DataFrame:
    """(stage, recall, lost): mean share of gold that each stage still holds, and queries with none."""
    g, out = evaluation.gold_of(gold, query_key, key), []
    sizes = g.sizes()
    for name, rows in stages.items():
        found = g.mark(rows.select(query_key, key).distinct()).where("__hit = 1").groupBy(query_key).agg(F.count("*").alias("hits"))
        met = sizes.join(found, query_key, "left").select((F.coalesce("hits", F.lit(0)) / F.col("ng")).alias("r"))
        out.append(met.agg(F.lit(name).alias("stage"), F.round(F.avg("r"), digits).alias("recall"), F.count_if(F.col("r") == 0).alias("lost")))
    return reduce(DataFrame.unionByName, out)


def error_taxonomy(gold: DataFrame, candidates: DataFrame, final: DataFrame, query_key: str, key: str) -> DataFrame:
    """(query_key, verdict): FOUND, LOST_IN_SELECTION, LOST_IN_RANKING or NOT_RETRIEVED."""
    g = evaluation.gold_of(gold, query_key, key)
    flag = lambda df, n: g.mark(df.select(query_key, key)).where("__hit = 1").select(query_key).distinct().withColumn(n, F.lit(True))
    rows = g.sizes().select(query_key).join(flag(candidates, "c"), query_key, "left").join(flag(final, "f"), query_key, "left")
    top = flag(candidates.where(F.col("rank") <= 10), "t")
    rows = rows.join(top, query_key, "left")
    return rows.select(query_key, F.when(F.col("f"), "FOUND").when(F.col("t"), "LOST_IN_SELECTION").when(F.col("c"), "LOST_IN_RANKING").otherwise("NOT_RETRIEVED").alias("verdict"))


def split_leaks(train: DataFrame, held: DataFrame, key: str, text: str) -> DataFrame:
    """(check, violations): identifiers and normalised texts that both splits hold."""
    t, h = (df.select(F.col(key).cast("string").alias("id"), T.query_key(F.col(text)).alias("q")) for df in (train, held))
    both = lambda c: t.select(c).distinct().join(h.select(c).distinct(), c, "left_semi").agg(F.count("*").alias("violations"))
    return both("id").select(F.lit("shared_ids").alias("check"), "violations").unionByName(both("q").select(F.lit("shared_texts").alias("check"), "violations"))


def reviewed(pairs: DataFrame, reviews: DataFrame, key: str, fixed: list[str]) -> DataFrame:
    """(key, verdict): reviews joined to their pairs; a review that changed a fixed field is REJECTED,
    several that disagree are CONFLICT, none is PENDING."""
    same = reduce(lambda a, b: a & b, [F.col(f"p.{c}").eqNullSafe(F.col(f"r.{c}")) for c in fixed])
    rows = pairs.alias("p").join(reviews.alias("r"), F.col(f"p.{key}") == F.col(f"r.{key}"), "left")
    rows = rows.select(F.col(f"p.{key}").alias(key), F.col("r.label").alias("label"), (F.col(f"r.{key}").isNotNull() & ~same).alias("changed"))
    verdict = F.when(F.max("changed"), "REJECTED").when(F.count_distinct("label") > 1, "CONFLICT").otherwise(F.coalesce(F.max("label"), F.lit("PENDING")))
    return rows.groupBy(key).agg(verdict.alias("verdict"))


def vector_agreement(a: DataFrame, b: DataFrame, key: str, vector: str, cosine: float = 0.99999, error: float = 1e-3) -> DataFrame:
    """Least cosine and greatest difference of two encodings of the same rows, and whether they agree."""
    o = b.select(key, F.col(vector).alias("__o"))
    rows = a.join(o, key).select(retrieval.dot(F.col(vector), F.col("__o")).alias("c"), F.array_max(F.zip_with(vector, "__o", lambda x, y: F.abs(x.cast("double") - y.cast("double")))).alias("e"))
    return rows.agg(F.count("*").alias("rows"), F.round(F.min("c"), 6).alias("least_cosine"), F.round(F.max("e"), 6).alias("most_error")).withColumn("agree", (F.col("least_cosine") >= cosine) & (F.col("most_error") <= error))


def assignment_progress(assigned: DataFrame, done: DataFrame, worker: str, key: str) -> DataFrame:
    """(worker, assigned, completed, remaining)."""
    d = done.select(key).distinct().withColumn("__d", F.lit(1))
    return assigned.join(d, key, "left").groupBy(worker).agg(F.count("*").alias("assigned"), F.count("__d").alias("completed"), (F.count("*") - F.count("__d")).alias("remaining"))


def exact_prefix(old: DataFrame, new: DataFrame, index: str, digest: str) -> DataFrame:
    """(parts, reusable): how many parts there were, and how many leading ones are unchanged."""
    o = old.select(F.col(index).alias("__i"), F.col(digest).alias("__d"))
    j = new.join(o, F.col(index) == F.col("__i"), "full").select(F.coalesce(index, "__i").alias("i"), F.col(digest).eqNullSafe(F.col("__d")).alias("same"))
    return j.agg(F.count("*").alias("parts"), F.coalesce(F.min(F.when(~F.col("same"), F.col("i"))), F.count("*")).cast("long").alias("reusable"))


def heading_hints(markdown: Column, text: Column) -> Column:
    """Headings of the markdown that are lines of the text."""
    return F.array_intersect(F.regexp_extract_all(markdown, F.lit(r"(?m)^#{1,6}\s+(.+)$"), F.lit(1)), F.transform(F.split(text, "\n"), lambda x: F.trim(x)))
