"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for the rest.

Everything is DataFrame columns. A url that a rule fits is a labelled url; from those the trees learn
what blocked urls look like, and they judge the urls that no rule fits. Features are lengths, depth,
digit ratio, character entropy, numbers of parameters, labels and hyphens, and the shares of blocked
urls of the host's last label, of the file's ending and of the first directory (suffix statistics;
while training, each half of the sample reads the statistics of the other half, so that no url sees
its own label).

Training takes the first SAMPLE distinct labelled urls in the order of a hash, one row a url whatever
its copies. A level of a tree is one aggregate: sums of gradients and of second derivatives by node,
feature and bin. Only these sums, at most nodes x features x bins rows, come to the driver, which
chooses the splits. Scoring is one CASE expression in the projection of the scan.

Defined results: a null url or one without `://` has empty host and path, fits no rule and is judged
by the trees; rows repeated or without identifier are judged like any other; without labelled urls
the trees allow everything; with labels of one kind alone they give that kind. Extra columns are not
read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialise

#: (host, path, verdict); a rule fits its host and all subdomains where the url's path starts with its path.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
SAMPLE, TREES, DEPTH, BINS, RATE, RIDGE, LEAST_WEIGHT, SMOOTHING = 20_000, 12, 3, 16, 0.3, 1.0, 1.0, 20.0
LEXICAL = ("url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "host_labels", "hyphens", "fragment")
SUFFIXES = ("host_suffix", "file_suffix", "directory")
FEATURES = LEXICAL + tuple(f"{s}_share" for s in SUFFIXES)


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, with A-Z in lower case; else empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty where there is no `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)


def matched(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host and path, its verdict) of the longest rule that fits; nulls where none does. The
    rules are a list the caller wrote, so they are part of the expression."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        hit = fits(host, path, h, p)
        rule, verdict = F.when(hit, F.lit(h + p)).otherwise(rule), F.when(hit, F.lit(v)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits a character of the text's own distribution, by runs of its sorted characters."""
    characters = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    run = lambda n: n * F.log2(F.greatest(n, F.lit(1.0)))
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))
    step = lambda a, c: F.when(a.last == c, F.struct(c.alias("last"), (a.run + 1.0).alias("run"), a.total.alias("total"))).otherwise(
        F.struct(c.alias("last"), F.lit(1.0).alias("run"), (a.total + run(a.run)).alias("total"))
    )
    n = F.char_length(text).cast("double")
    return F.when(n > 0, F.log2(n) - F.aggregate(characters, start, step, lambda a: a.total + run(a.run)) / n).otherwise(F.lit(0.0))


def parsed(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """key, url, host, path, rule and the rule's verdict."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    return rows.withColumn("rule", rule).withColumn("ruled", verdict)


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the lexical features and the hashed suffixes of parsed rows."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    n = F.char_length(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    count = lambda text, of: F.char_length(F.regexp_replace(text, f"[^{of}]", "")).cast("double")
    columns = {
        "url_length": n.cast("double"),
        "host_length": F.char_length(host).cast("double"),
        "path_length": F.char_length(path).cast("double"),
        "depth": count(path, "/"),
        "digit_ratio": F.when(n > 0, count(url, "0-9") / n).otherwise(F.lit(0.0)),
        "entropy": F.round(entropy(url), 9),
        "parameters": F.when(query != "", count(query, "&") + 1.0).otherwise(F.lit(0.0)),
        "host_labels": F.when(host != "", count(host, ".") + 1.0).otherwise(F.lit(0.0)),
        "hyphens": count(host, "-"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "host_suffix": F.xxhash64(F.substring_index(host, ".", -1)),
        "file_suffix": F.xxhash64(F.regexp_extract(path, r"([.][^./]*|/)$", 1)),
        "directory": F.xxhash64(F.regexp_extract(path, r"^/([^/]*)/", 1)),
    }
    return rows.select("*", *[c.alias(k) for k, c in columns.items()])


@dataclass(frozen=True)
class Model:
    """What training leaves: cut points, trees as nested (feature, cut, left, right) or leaf values,
    and the tables of suffix statistics, which have at most as many rows as the sample."""

    cuts: dict
    trees: tuple
    base: float
    share: float
    tables: tuple[DataFrame, ...]


def _share(blocked: Column, n: Column, share: float) -> Column:
    return (blocked + F.lit(share * SMOOTHING)) / (n + F.lit(SMOOTHING))


def _statistics(sample: DataFrame, name: str, share: float, by: list[str]) -> DataFrame:
    sums = sample.groupBy(F.col(name).alias("suffix"), *by).agg(F.sum("y").alias("blocked"), F.count("*").alias("n"))
    return sums.select("suffix", *by, _share(F.col("blocked"), F.col("n"), share).alias("share"))


def _with_shares(rows: DataFrame, tables, share: float, by: list[str] = ()) -> DataFrame:
    """Joins the small tables of statistics; a suffix that they lack has the overall share."""
    for table, name in zip(tables, SUFFIXES, strict=True):
        other = F.broadcast(table.withColumnsRenamed({"suffix": name, "share": f"{name}_share"}))
        rows = rows.join(other, [name, *by], "left").withColumn(f"{name}_share", F.coalesce(f"{name}_share", F.lit(share)))
    return rows


def _value(tree, test) -> str:
    """A tree as SQL; test(feature, cut) is the condition of its left side."""
    if not isinstance(tree, tuple):
        return f"{float(tree)!r}D"
    feature, cut, left, right = tree
    return f"CASE WHEN {test(feature, cut)} THEN {_value(left, test)} ELSE {_value(right, test)} END"


def _margin(base: float, trees, test) -> Column:
    return F.expr(" + ".join([f"{base!r}D", *[_value(t, test) for t in trees]]))


def best_split(bins: dict, features: int) -> tuple | None:
    """(gain, feature, cut, left sums, right sums) of the best split of a node, from its sums (gradient, second
    derivative) by (feature, bin); None where no split gains. Ties go to the first feature and cut."""
    best = None
    for f in range(features):
        mine = sorted((b, s) for (g, b), s in bins.items() if g == f)
        total = tuple(math.fsum(s[i] for _, s in mine) for i in (0, 1))
        left = [0.0, 0.0]
        for b, s in mine[:-1]:
            left = [left[0] + s[0], left[1] + s[1]]
            right = [total[0] - left[0], total[1] - left[1]]
            if min(left[1], right[1]) < LEAST_WEIGHT:
                continue
            gain = round(sum(x[0] ** 2 / (x[1] + RIDGE) for x in (left, right)) - total[0] ** 2 / (total[1] + RIDGE), 6)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, f, b, tuple(left), tuple(right))
    return best


def _leaf(sums) -> float:
    return round(-RATE * sums[0] / (sums[1] + RIDGE), 9)


def _grow(sample: DataFrame, base: float, trees: list) -> object:
    """One more tree: a level is one aggregate over the sample."""
    test = lambda f, b: f"b{f} <= {b}"
    chance = 1 / (1 + F.exp(-F.col("margin")))
    rows = sample.withColumn("margin", _margin(base, trees, test)).select("*", (chance - F.col("y")).alias("g"), (chance * (1 - chance)).alias("h"))
    splits: dict[int, tuple] = {}
    sums: dict[int, tuple] = {}

    def node(i: int) -> str:
        return f"CASE WHEN {test(*splits[i][1:3])} THEN {node(2 * i)} ELSE {node(2 * i + 1)} END" if i in splits else str(i)

    level = [1]
    for _ in range(DEPTH):
        spread = rows.select(F.expr(node(1)).alias("node"), "g", "h", F.posexplode(F.array(*[f"b{f}" for f in range(len(FEATURES))])).alias("feature", "bin"))
        found = spread.where(F.col("node").isin(level)).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        by_node: dict[int, dict] = {}
        for r in found.collect():  # nodes x features x bins
            by_node.setdefault(r.node, {})[r.feature, r.bin] = (r.g, r.h)
        level = []
        for i, bins in sorted(by_node.items()):
            if i == 1:
                sums[1] = tuple(math.fsum(s[k] for (f, _), s in bins.items() if f == 0) for k in (0, 1))
            split = best_split(bins, len(FEATURES))
            if split:
                splits[i] = split
                sums[2 * i], sums[2 * i + 1] = split[3], split[4]
                level += [2 * i, 2 * i + 1]
        if not level:
            break
    build = lambda i: (splits[i][1], splits[i][2], build(2 * i), build(2 * i + 1)) if i in splits else _leaf(sums[i])
    return build(1)


def fit(rows: DataFrame, sample: int = SAMPLE, trees: int = TREES) -> Model:
    """Trees from the parsed rows that a rule fits: the first `sample` distinct urls in hash order."""
    labelled = rows.where("rule IS NOT NULL").select("url", "host", "path", (F.col("ruled") == "block").cast("double").alias("y")).dropDuplicates(["url"])
    chosen = lexical(labelled).select(*LEXICAL, *SUFFIXES, "y", F.xxhash64("url").alias("order"), F.pmod(F.xxhash64("url", F.lit("half")), F.lit(2)).alias("half"))
    chosen = materialise(chosen.orderBy("order", *LEXICAL).limit(sample), "url_sample").coalesce(1)  # bounded: one task, no shuffles
    n, blocked = chosen.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if blocked in (0.0, float(n)):
        return Model({}, (), -10.0 if blocked == 0 else 10.0, float(blocked > 0), ())
    share = blocked / n
    other = chosen.withColumn("half", 1 - F.col("half"))
    rows = _with_shares(chosen, [_statistics(other, k, share, ["half"]) for k in SUFFIXES], share, ["half"])
    points = rows.agg(*[F.percentile(f, F.lit([i / BINS for i in range(1, BINS)])).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted({float(x) for x in points[f]}) for f in FEATURES}
    binned = [sum((F.col(f) > c).cast("int") for c in cuts[f]).alias(f"b{i}") for i, f in enumerate(FEATURES)]
    binned = materialise(rows.select("y", *binned), "url_bins").coalesce(1)
    base, grown = round(math.log(share / (1 - share)), 9), []
    for _ in range(trees):
        grown.append(_grow(binned, base, grown))
    tables = tuple(materialise(_statistics(chosen, k, share, []), "url_suffixes") for k in SUFFIXES)
    return Model(cuts, tuple(grown), base, share, tables)


def margin(model: Model) -> Column:
    """The log-odds of block over columns named like the features."""
    return _margin(model.base, model.trees, lambda f, b: f"{FEATURES[f]} <= {model.cuts[FEATURES[f]][b]!r}D")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, model: Model | None = None) -> DataFrame:
    """key, host, path, rule, verdict (the rule's, else the trees'), block_score (the trees' chance
    of block, for every row)."""
    rows = parsed(pages, key, url, rules)
    model = model or fit(rows)
    scored = _with_shares(lexical(rows), model.tables, model.share) if model.tables else rows
    chance = F.round(1 / (1 + F.exp(-margin(model))), 6)
    scored = scored.select("key", "host", "path", "rule", "ruled", chance.alias("block_score"))
    verdict = F.coalesce("ruled", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return scored.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "block_score")
