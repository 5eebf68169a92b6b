"""Relational corpus algebra: profiles, inventory, intake, union, positions and parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import urls


def key_profile(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows, distinct and null keys, range of keys and blank texts, in one pass."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(key).alias("unique_ids"),
        F.count_if(F.col(key).isNull()).alias("null_ids"),
        F.min(key).alias("min_id"),
        F.max(key).alias("max_id"),
        F.count_if(F.col(text).isNull() | (F.trim(F.col(text)) == "")).alias("empty_text"),
    )


def length_quantiles(df: DataFrame, value: Column, points=(0.5, 0.95), digits: int = 6) -> DataFrame:
    """Least, interpolated quantiles and greatest; exact, by rank."""
    names = {0.0: "least", **{x: f"p{int(100 * x)}" for x in points}, 1.0: "most"}
    got = exact_quantiles(df.select(value.alias("v")), [], "v", list(names))
    row = got.agg(*[F.max(F.when(F.col("point") == x, F.col("quantile"))).alias(n) for x, n in names.items()])
    kind = df.select(value.alias("v")).schema["v"].dataType
    return row.select(F.col("least").cast(kind).alias("least"), *[F.round(names[x], digits).alias(names[x]) for x in points], F.col("most").cast(kind).alias("most"))


def quantile_columns(df: DataFrame, by: list[str], value: str, points: dict[str, float], digits: int = 6) -> DataFrame:
    """One row a group with a column for each point."""
    got = exact_quantiles(df, by, value, list(points.values()))
    return got.groupBy(*by).agg(*[F.round(F.max(F.when(F.col("point") == x, F.col("quantile"))), digits).alias(n) for n, x in points.items()])


def group_count(df: DataFrame, *by: str, name: str = "rows") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(name))


def url_inventory(links: DataFrame, key: str = "id", url: str = "url") -> DataFrame:
    u = F.col(url)
    return links.select(F.col(key).alias("id"), u.alias("url"), urls.canonical_url(u).alias("canonical_url"), urls.scheme(u).alias("scheme"), urls.domain(u).alias("domain"), urls.path(u).alias("path"), urls.extension(u).alias("extension"), urls.is_valid(u).alias("url_valid"))


def domain_ranks(inventory: DataFrame) -> DataFrame:
    """Population of each domain, and its rank by population and name; no global window."""
    counted = group_count(inventory, "domain", name="population")
    return positions(counted, [F.desc("population"), F.asc("domain")], "domain_rank").withColumn("domain_rank", F.col("domain_rank") + 1)


def with_strata(inventory: DataFrame, top: int = 30, medium: int = 300) -> DataFrame:
    """Tier by rank of the domain, hints of format and language, and their stratum."""
    ranked = inventory.join(domain_ranks(inventory), "domain")
    tier = F.when(F.col("domain_rank") <= top, "top").when(F.col("domain_rank") <= medium, "medium").otherwise("long_tail")
    form = F.when(F.col("extension") == "pdf", "pdf").when(F.col("extension") == "xml", "xml").when(F.col("extension").isin("", "html", "htm", "php", "aspx"), "html_like").otherwise("other")
    lang = F.when(F.col("domain").endswith(".vn"), "vi_like").when(F.col("domain").endswith(".cn"), "zh_like").otherwise("unknown")
    valid = F.when(F.col("url_valid"), "valid").otherwise("invalid")
    return ranked.withColumns({"domain_tier": tier, "format_hint": form, "language_hint": lang}).withColumn("stratum", F.concat_ws(":", "domain_tier", "format_hint", "language_hint", valid))


def first_per_group(df: DataFrame, n: int, by: list[str], order: list) -> DataFrame:
    """The first n rows of each group; Spark prunes each task's groups before the shuffle."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__rn") <= n).drop("__rn")


def seeded(seed: int, *columns) -> Column:
    """A reproducible random order: a hash of the seed and the columns, the same in any engine."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]), 256)


def stratified_sample(strata: DataFrame, size: int, seed: int, key: str = "id", group: str = "domain", stratum: str = "stratum") -> DataFrame:
    """Rounds over strata, and within a stratum over its groups, in seeded order; the first `size`.

    Only identifiers and group names pass the windows. Of each stratum no more than `size` rows can
    be chosen, which Spark's group limit applies in each task.
    """
    narrow = strata.select(key, group, stratum)
    inner = narrow.withColumn("a", F.row_number().over(Window.partitionBy(stratum, group).orderBy(seeded(seed, key), key)))
    outer = inner.withColumn("b", F.row_number().over(Window.partitionBy(stratum).orderBy("a", seeded(seed, group), key))).where(F.col("b") <= size)
    return outer.orderBy("b", seeded(seed, stratum), key).limit(size).select(key, group, stratum)


def population_and_sample(population: DataFrame, sample: DataFrame, by: str) -> DataFrame:
    return group_count(population, by, name="population").join(group_count(sample, by, name="sample_rows"), by, "left").na.fill(0, ["sample_rows"])


def missing(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of left whose key right lacks: an anti join, not an outer join and a test for null."""
    return left.join(right.select(*on).distinct() if len(right.columns) > len(on) else right, on, "left_anti")


def pair_mismatches(subset: DataFrame, official: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of subset whose (key, value) is not that of official; nulls compare as values."""
    other = official.select(F.col(key).alias("__k"), F.col(value).alias("__v"), F.lit(True).alias("__met"))
    return subset.join(other, subset[key] == other["__k"], "left").where(F.col("__met").isNull() | ~F.col(value).eqNullSafe(F.col("__v"))).select(*subset.columns)


def division(candidates: DataFrame, required: DataFrame, existing: DataFrame, group: str, member: str) -> DataFrame:
    """(group, action): REUSED where every required member of the group exists, else QUEUED."""
    lacking = required.join(existing.select(member).distinct(), member, "left_anti").select(group).distinct().withColumn("__lack", F.lit(True))
    return candidates.select(group).distinct().join(lacking, group, "left").select(group, F.when(F.col("__lack"), "QUEUED").otherwise("REUSED").alias("action"))


def alias_join(official: DataFrame, frontier: DataFrame, key: str, url: str, fetch: str) -> DataFrame:
    """Every official identifier with the frontier row that its fetched URL stands for."""
    return official.withColumn("__f", urls.fetch_url(F.col(url))).join(frontier, F.col("__f") == F.col(fetch)).drop("__f")


def frontier(official: DataFrame, key: str, url: str) -> DataFrame:
    """One row a fetched URL, with its least identifier and number of aliases."""
    return official.select(key, urls.fetch_url(F.col(url)).alias("fetch_url")).groupBy("fetch_url").agg(F.min(key).alias("crawl_url_id"), F.count("*").alias("doc_count"))


def tagged_union(sources: list[DataFrame], tag: str = "origin") -> DataFrame:
    """All rows of all sources, each with the ordinal of its source."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.withColumn(tag, F.lit(i)) for i, s in enumerate(sources)])


def first_source(union: DataFrame, key: str, order: list, tag: str = "origin") -> DataFrame:
    """(key, origin) of the row that wins for each key: an aggregate, so nothing is sorted."""
    least = F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(tag)))
    return union.groupBy(key).agg(least[tag].alias(tag))


def union_conflicts(union: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Keys for which sources disagree on a value; nulls do not count as values."""
    counts = [F.count_distinct(v).alias(f"n_{v}") for v in values]
    return union.groupBy(key).agg(*counts).where(reduce(lambda a, b: a | b, [F.col(f"n_{v}") > 1 for v in values]))


def group_fingerprint(rows: DataFrame, by: list[str], content: list[str]) -> DataFrame:
    """(by, rows, digest): SHA-256 over the ascending hashes of a group's rows. Only fixed-size
    hashes are gathered, never texts."""
    hashed = rows.select(*by, F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in content]), 256).alias("h"))
    return hashed.groupBy(*by).agg(F.count("*").alias("rows"), F.sha2(F.concat_ws("", F.array_sort(F.collect_list("h"))), 256).alias("digest"))


def fingerprints_agree(prints: DataFrame, key: str, tag: str = "origin") -> DataFrame:
    """Keys in several sources whose fingerprints differ."""
    return prints.groupBy(key).agg(F.count_distinct(tag).alias("origins"), F.count_distinct("digest", "rows").alias("versions")).where((F.col("origins") > 1) & (F.col("versions") > 1))


def positions(rows: DataFrame, order, name: str = "position", partitions: int | None = None) -> DataFrame:
    """Dense positions from 0 in the given order, without bringing all rows to one task.

    order: a column or a list of them, a total order. Rows are dealt by range, numbered within their
    partition and written; offsets, a running sum over one count a partition, and rows are both read
    from there, as a second dealing by range might draw other bounds.
    """
    from tessera.session import materialise, shuffle_partitions

    keys = order if isinstance(order, list) else [order]
    n = partitions or shuffle_partitions(rows.sparkSession)
    dealt = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
    # the identifier is the partition's number, and below 33 bits the row's number in it
    local = materialise(dealt.select(*rows.columns, F.shiftright("__id", 33).alias("__p"), (F.col("__id").bitwiseAND((1 << 33) - 1) + 1).alias("__r")), "positions")
    sizes = local.groupBy("__p").agg(F.count("*").alias("__n"))
    starts = sizes.withColumn("__s", F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))).select("__p", F.coalesce("__s", F.lit(0)).alias("__s"))
    return local.join(F.broadcast(starts), "__p").withColumn(name, (F.col("__s") + F.col("__r") - 1).cast("long")).drop("__p", "__r", "__s")


def range_parts(positioned: DataFrame, size: int, name: str = "position") -> DataFrame:
    """(part, first, last, rows) of ranges of `size` positions."""
    return positioned.withColumn("part", F.floor(F.col(name) / size)).groupBy("part").agg(F.min(name).alias("first"), F.max(name).alias("last"), F.count("*").alias("rows"))


def range_complete(parts: DataFrame, first: str, rows: str) -> DataFrame:
    """Parts that leave a gap or overlap with the part before, with the place `expected` of them."""
    from tessera.operators.ordered import following

    return following(parts, first, rows).where(F.col("expected").isNotNull() & (F.col("expected") != F.col(first)))


def keyset_page(df: DataFrame, key: str, after, n: int) -> DataFrame:
    """The next n rows by key: a filter that the scan takes, and a top-k without a full sort."""
    return df.where(F.col(key) > F.lit(after)).orderBy(key).limit(n)


def representatives(rows: DataFrame, content: Column, key: str, carry: list[str]) -> DataFrame:
    """For each content hash the row of the least key, and how many share it."""
    least = F.min_by(F.struct(*[F.col(c) for c in carry]), F.col(key))
    return rows.withColumn("content_hash", F.sha2(content, 256)).groupBy("content_hash").agg(F.min(key).alias("representative"), F.count("*").alias("aliases"), least.alias("__c")).select("content_hash", "representative", "aliases", *[F.col("__c")[c].alias(c) for c in carry])


def cache_coverage(inputs: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """How many inputs a cache of encodings already holds."""
    held = cache.select(F.col(key).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    return inputs.join(held, inputs[key] == held["__k"], "left").agg(F.count("*").alias("inputs"), F.count_if(F.col("__hit").isNotNull()).alias("cached"), F.count_if(F.col("__hit").isNull()).alias("missing"))


def modulo_worker(key: Column, workers: int) -> Column:
    """The worker of a hex key, by its first eight digits."""
    return F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), F.lit(workers)).cast("int")


def drift(now: DataFrame, before: DataFrame, metric: str, value: str, threshold: float) -> DataFrame:
    """Relative change of each metric against a baseline, with a warning where it is large."""
    b = before.select(metric, F.col(value).alias("baseline"))
    change = F.when(F.col("baseline") == 0, F.when(F.col(value) == 0, 0.0).otherwise(1.0)).otherwise((F.col(value) - F.col("baseline")) / F.abs("baseline"))
    return now.join(b, metric).select(metric, F.round(value, 6).alias("value"), F.round("baseline", 6).alias("baseline"), F.round(change, 6).alias("change"), (F.abs(change) > threshold).alias("warning"))


def evenly_spaced(rows: DataFrame, order, n: int) -> DataFrame:
    """About n rows in even steps of the order: those at positions floor(i * rows / n)."""
    placed = positions(rows, order)
    total = placed.agg(F.count("*").alias("__total"))
    wanted = total.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"), "__total").select(F.floor(F.col("i") * F.col("__total") / n).alias("position")).distinct()  # n rows
    return placed.join(wanted, "position")


def exact_quantiles(rows: DataFrame, by: list[str], value: str, points: list[float]) -> DataFrame:
    """(by, point, quantile): interpolated quantiles of each group, nulls left out. Values are put in
    order by range and picked by rank, so that no group is held in one buffer."""
    placed = positions(rows.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v"), F.monotonically_increasing_id().alias("__u")), [*by, "v", "__u"])
    groups = placed.groupBy(*by).agg(F.min("position").alias("first"), F.count("*").alias("n"))
    at = groups.select(*by, "first", F.explode(F.array(*[F.struct(F.lit(float(p)).alias("point"), (F.lit(float(p)) * (F.col("n") - 1)).alias("h")) for p in points])).alias("p")).select(*by, "p.point", (F.col("first") + F.floor("p.h")).alias("low"), (F.col("first") + F.ceil("p.h")).alias("high"), (F.col("p.h") - F.floor("p.h")).alias("share"))
    values = placed.select("position", "v")
    got = at.join(values.withColumnsRenamed({"position": "low", "v": "a"}), "low").join(values.withColumnsRenamed({"position": "high", "v": "b"}), "high")
    return got.select(*by, "point", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias("quantile"))


def merged_counters(parts: DataFrame, counters: str) -> DataFrame:
    """(name, n): the sum over parts of a column of maps from name to count."""
    return parts.select(F.explode(counters).alias("name", "n")).groupBy("name").agg(F.sum("n").alias("n"))


def inner_without(left: DataFrame, middle: DataFrame, on: str, right: DataFrame, by: str) -> DataFrame:
    """Rows of left that meet a row of middle, joined with it, and no row of right."""
    return left.join(middle, on).join(right.select(by), by, "left_anti")


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of the row as JSON, its columns in the order of their names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
