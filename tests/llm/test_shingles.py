"""Near copies on word shingles against brute force."""

import random

import corpus_pipeline
from tessera.llm import shingles, simhash


def sets(t, n=5):
    w = (t or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def similarity(a, b):
    a, b = sets(a), sets(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_stage_keeps_one_of_each_group(spark, sf_dir):
    rng = random.Random(4)
    texts = []
    for size in [6, 12, 40, 120, 300] * 8:
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        for edits in (0, 1, max(1, size // 60), size // 8):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    group = {i: i for i, _ in rows}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    far = 0
    for i, a in rows:
        for j, b in rows[:i]:
            if similarity(a, b) >= 0.8:
                far += (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() > 4
                x, y = sorted((find(i), find(j)))
                group[y] = x
    assert far > 5  # what four bits of a fingerprint leave apart
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, sf_dir).collect()}
    assert got == {i for i, _ in rows if find(i) == i}


def test_rows_without_a_key_and_shared_keys(spark):
    rows = [(None, "alone among all the others here"), (None, "one two three four five six"), (2, "one two three four five six"), (2, "one two three four five six"), (7, "this key has a text"), (7, "and then quite another one"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as fp", "1 as node")
    got = shingles.keep_one(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted({rows[0], rows[2], rows[4], rows[5], rows[6]}, key=str)
    assert shingles.keep_one(df.limit(0)).count() == 0


def test_a_group_larger_than_the_steps_is_whole(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:k] + [f"y{i}"] + base[k + 1 :])) for i in range(150) for k in [(i * 7) % 200]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in shingles.keep_one(df).collect()] == [0]


def test_clusters_of_several_blocks_lose_no_pair(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(240):  # about half of the pairs of near copies reach the similarity
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 12])):
            copy[rng.randrange(60)] = f"x{i}{rng.randrange(99)}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r.doc_id for r in shingles.keep_one(df).collect()}
    monkeypatch.setattr(shingles, "BLOCK_TEXTS", 16)
    assert {r.doc_id for r in shingles.keep_one(df).collect()} == whole
    label = list(range(len(rows)))
    for i, a in rows:
        for j, b in rows[:i]:
            if label[i] != label[j] and similarity(a, b) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert whole == set(label) and 1 < len(whole) < 240
