"""The similarity join shuffles no row for two sets that only share a rare word."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import set_join


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_unlike_sets_that_share_a_rare_word_are_no_candidates(spark):
    """Two hundred sets of one rare word and thirty of their own, and two that are near: 20,301 pairs meet."""
    sets = [["rare", *[f"w{i}x{j}" for j in range(30)]] for i in range(200)]
    sets += [["rare", *[f"n{j}" for j in range(29)], x] for x in ("a", "b")]
    left = spark.createDataFrame([(bytes([i]), sorted(w)) for i, w in enumerate(sets)], "set binary, words array<string>")
    assert [tuple(map(bytes, r)) for r in set_join.candidates(left, None, 0.7).collect()] == [(bytes([200]), bytes([201]))]


@pytest.mark.parametrize("threshold", [0.3, 0.7, 1.0])
def test_a_join_with_itself_equals_all_pairs(spark, threshold):
    """Small vocabularies and sets of up to 400 words, which fill their bit fields."""
    rng = random.Random(4)
    rows = []
    for i in range(150):
        base = rng.choice(rows)[1] if rows and i % 3 == 0 else [f"w{rng.randrange(600)}" for _ in range(rng.choice([1, 4, 12, 60, 400]))]
        rows.append((i, [w for w in base if rng.random() < 0.95] or ["w"]))
    pairs, members = set_join.self_join(spark.createDataFrame([*rows, (900, None), (901, [])], "k long, w array<string>"), "k", F.col("w"), threshold)
    least = members.groupBy("set").agg(F.min("k").alias("k"))
    found = pairs.join(least.toDF("left_set", "l"), "left_set").join(least.toDF("right_set", "r"), "right_set").collect()
    sets = {}
    for i, w in rows:
        sets.setdefault(frozenset(w), i)
    want = {(i, j): jaccard(a, b) for a, i in sets.items() for b, j in sets.items() if i < j and jaccard(a, b) >= threshold}
    assert {tuple(sorted((r.l, r.r))): round(r.similarity, 9) for r in found} == {k: round(v, 9) for k, v in want.items()} and len(found) == len(want)
