"""Exact similarity join of two collections of word sets, and the independence of query sets by it.

Two sets whose Jaccard similarity is at least t share a word among their first n - ceil(t n) + 1 words,
whatever the order of words, as long as it is the same for both. The order is rarest first, so what is
joined on are the rare words of a set; sizes, the places of the shared word in both sets, and a bit field
of each rule out most of what meets there, and the rest is decided by the sets themselves. Equal sets are one set with
members, so copies meet once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialise

#: What rounding may take from a product of a size and the threshold.
SLACK = 1e-9


#: Longs of the bit field of a set: each word sets one bit, so two sets differ in as many words at least as
#: their fields differ in bits.
FIELD = 4


def _sets(rows: DataFrame, key: str, words: Column, least: int) -> DataFrame:
    """(key, set, words): the distinct words in order and a digest of them; smaller sets are left out."""
    sets = rows.select(F.col(key).alias("key"), F.array_sort(F.array_distinct(words)).alias("words")).where(F.size("words") >= least)
    return sets.withColumn("set", F.unhex(F.sha2(F.concat_ws("\x1f", "words"), 256)))


def _prefixes(sets: DataFrame, frequency: DataFrame, threshold: float) -> DataFrame:
    """(set, n, bits, word, place) of the words of each set that a partner must share one of."""
    ranked = sets.select("set", F.size("words").alias("n"), F.explode("words").alias("word")).join(frequency, "word")
    bit = F.pmod(F.xxhash64("word"), F.lit(64 * FIELD)).cast("int")
    bits = [F.bit_or(F.when(F.floor(bit / 64) == i, F.expr("shiftleft(1L, cast(pmod(xxhash64(word), 64) AS int))")).otherwise(F.lit(0).cast("long"))) for i in range(FIELD)]
    ordered = ranked.groupBy("set", "n").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("w"), F.array(*bits).alias("bits"))
    length = (F.col("n") - F.ceil(F.col("n") * threshold - SLACK) + 1).cast("int")
    return ordered.select("set", "n", "bits", F.posexplode(F.transform(F.slice("w", 1, length), lambda x: x["word"])).alias("place", "word"))


def candidates(left: DataFrame, right: DataFrame | None, threshold: float) -> DataFrame:
    """(left_set, right_set) of all pairs of `similar_sets`, and few others: what shares a word is judged where
    it meets, by sizes, places and bit fields, and only pairs that all three leave are rows of a shuffle."""
    both = left if right is None else left.unionByName(right)
    frequency = both.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    a = materialise(_prefixes(left, frequency, threshold), "prefixes")
    b = a if right is None else materialise(_prefixes(right, frequency, threshold), "prefixes")
    side = lambda rows, name, n: rows.select("word", F.col("set").alias(f"{name}_set"), F.col("n").alias(f"n{n}"), F.col("place").alias(f"p{n}"), *[F.col("bits")[i].alias(f"b{n}_{i}") for i in range(FIELD)])
    met = side(a, "left", 1).join(side(b, "right", 2), "word")
    least = threshold / (1 + threshold) * (F.col("n1") + F.col("n2")) - SLACK
    # the first shared word in the common order has the most words behind it: of a similar pair it reaches `least`
    reachable = F.least(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2"))
    near = (F.col("n2") >= F.col("n1") * threshold - SLACK) & (F.col("n1") >= F.col("n2") * threshold - SLACK)
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"b1_{i}").bitwiseXOR(F.col(f"b2_{i}"))) for i in range(FIELD)])
    near &= (reachable >= least) & ((F.col("n1") + F.col("n2") - apart) / 2 >= least)
    if right is None:
        near &= F.col("left_set") < F.col("right_set")
    return met.where(near).select("left_set", "right_set").distinct()


def similar_sets(left: DataFrame, right: DataFrame | None, threshold: float) -> DataFrame:
    """(left_set, right_set, common, similarity) of all pairs of sets with at least that similarity; both
    sides are (set, words), each set once. Without a right side, the pairs of unlike sets of the left, once."""
    full = candidates(left, right, threshold).join(left.select(F.col("set").alias("left_set"), F.col("words").alias("w1")), "left_set").join((left if right is None else right).select(F.col("set").alias("right_set"), F.col("words").alias("w2")), "right_set")
    common = F.size(F.array_intersect("w1", "w2"))
    found = full.select("left_set", "right_set", common.alias("common"), (F.size("w1") + F.size("w2") - common).alias("all"))
    return found.select("left_set", "right_set", "common", (F.col("common") / F.col("all")).alias("similarity")).where(F.col("similarity") >= threshold)


def _once(sets: DataFrame) -> DataFrame:
    """Each set once: equal sets have equal words."""
    return sets.groupBy("set").agg(F.first("words").alias("words"))


def similarity_join(left: DataFrame, left_key: str, left_words: Column, right: DataFrame, right_key: str, right_words: Column, threshold: float = 0.9, least_words: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs of sets, members of the left sets, members of the right sets). Rows with fewer distinct
    words than least_words, null ones included, have no set."""
    a, b = (materialise(_sets(rows, key, words, max(1, least_words)), "sets") for rows, key, words in ((left, left_key, left_words), (right, right_key, right_words)))
    pairs = similar_sets(_once(a), _once(b), threshold)
    return pairs, a.select(F.col("key").alias(left_key), "set"), b.select(F.col("key").alias(right_key), "set")


def self_join(rows: DataFrame, key: str, words: Column, threshold: float = 0.9, least_words: int = 1) -> tuple[DataFrame, DataFrame]:
    """(pairs of unlike sets, each once; members) of one collection with itself, as `similarity_join`."""
    a = materialise(_sets(rows, key, words, max(1, least_words)), "sets")
    return similar_sets(_once(a), None, threshold), a.select(F.col("key").alias(key), "set")


def independence(queries: DataFrame, key: str, words: Column, others: DataFrame, other_words: Column, most: float = 0.9, least_words: int = 5) -> DataFrame:
    """(key, has_words, same_text, near_words, independent) of every query against the whole other set.

    A query is independent if it has words, no other query has the same words in the same order, and
    none of at least least_words distinct words has a word set of Jaccard similarity `most` or more;
    that is judged for queries of least_words themselves.
    """
    text = lambda w: F.concat_ws(" ", w)
    own = queries.select(F.col(key), F.coalesce(text(words), F.lit("")).alias("text")).withColumn("has_words", F.col("text") != "")
    taken = others.select(text(other_words).alias("text")).where("text <> ''").distinct().withColumn("same_text", F.lit(True))
    other = others.select(other_words.alias("w")).withColumn("o", F.lit(0))
    pairs, members, _ = similarity_join(queries, key, words, other, "o", F.col("w"), most, least_words)
    close = members.join(pairs.select(F.col("left_set").alias("set")).distinct(), "set").select(F.col(key).alias("__near")).distinct().withColumn("near_words", F.lit(True))
    found = own.join(taken, "text", "left").join(close, F.col(key).eqNullSafe(F.col("__near")), "left")
    found = found.select(key, "has_words", F.coalesce("same_text", F.lit(False)).alias("same_text"), F.coalesce("near_words", F.lit(False)).alias("near_words"))
    return found.withColumn("independent", F.col("has_words") & ~F.col("same_text") & ~F.col("near_words"))
