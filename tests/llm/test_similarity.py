"""Near-duplicate operators and decontamination against brute force."""

import re

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tessera.llm import registry, rotation, simhash, templates
from tessera.operators.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def closure(near):
    label = np.arange(len(near))
    while True:
        new = np.where(near, label[None, :], len(near)).min(axis=1)
        new = np.minimum(new, label)
        if (new == label).all():
            return label
        label = new


def slow_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for t in [None, "", " \n", "a", "A b", "a b c d e f a b c d", "É é ß \x0b\x1c x", "w " * 40_000, " ".join(map(str, range(50_000)))]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def crowded(seed, groups, members):
    rng = np.random.default_rng(seed)
    out = set()
    for base in rng.integers(0, 2**63, groups, dtype=np.uint64):
        for _ in range(members):
            x = int(base)
            for k in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(k)
            out.add(x)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("cell,block", [(1 << 20, 1 << 20), (300, 50), (8, 1 << 20), (0.01, 100), (0.00001, 100)])
def test_links_connect_all_that_brute_force_connects(spark, cell, block):
    fp = crowded(5, 8, 120)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    label = closure(near)
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    found = simhash.links(df, cell=cell, block=block).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in found)  # every edge is a link
    assert len(found) < 100 * len(fp)  # forests, not pairs
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(found, "a long, b long"), "a", "b").collect()}
    named = [got.get(int(x), int(x)) for x in fp.view(np.int64)]
    assert len(set(zip(label, named))) == len(set(label)) == len(set(named))


def test_tables_are_complete():
    rng = np.random.default_rng(3)
    for n in (1, 2000, 10**5, 10**7, 10**9, 10**12):
        masks = simhash.tables(n)
        for _ in range(500):
            flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(not flips & m for m in masks)


def test_the_tree_decides_the_pairs_of_the_real_tables(spark):
    fp = np.array([r.fp for r in simhash.fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).distinct().collect()], np.int64).view(np.uint64)
    fp = np.unique(fp)
    forest = simhash.Forest(len(fp))
    simhash.tree_links(fp, np.arange(len(fp)), np.arange(0), 4, forest)
    assert (closure(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4) == forest.label).all()
    assert forest.pruned > len(fp) and forest.compared < 0.75 * len(fp) ** 2 / 2


def test_simhash_query_equals_brute_force(spark):
    base = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    ids = sorted(docs)
    fp = np.array([slow_fingerprint(docs[i]) for i in ids], np.uint64)
    label = closure(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4)
    want = {i: (f"{int(f):016x}", ids[c]) for i, f, c in zip(ids, fp, label)}
    got = registry.queries()["op3_simhash"](spark, base).collect()
    assert len(got) == len(ids) and {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def test_groups_of_odd_rows(spark):
    rows = [(5, None), (4, ""), (3, "one two three four five"), (2, "one two three four five"), (2, "one two three four five"), (9, "x " * 3000), (None, "one two three four five"), (None, "alone among all the others here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as fp", "1 as component_id", "2 as k")
    got = simhash.groups(df).collect()
    assert len(got) == len(rows)
    of = {}
    for r in got:
        of.setdefault(r.doc_id, set()).add(r.component_id)
    assert of[5] == of[4] == {4} and of[3] == of[2] == {2} and of[9] == {9} and of[None] == {2, None}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [2, 4, 9]
    empty = df.limit(0)
    assert simhash.groups(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def brute_links(rows, threshold=0.93):
    n = len(rows)
    near = np.zeros((n, n), bool)
    for i, (_, e, g) in enumerate(rows):
        for j, (_, f, h) in enumerate(rows):
            if i != j and g is not None and g == h and e and f and len(e) == len(f):
                a, b = np.array(e, float), np.array(f, float)
                if np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any():
                    a, b = a / np.abs(a).max(), b / np.abs(b).max()
                    near[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    return near


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for c in range(12):
        base = rng.standard_normal(16)
        for _ in range(20):
            rows.append((len(rows), [float(x) for x in base + rng.standard_normal(16) * rng.choice([0.05, 0.25, 0.4])], int(c % 3)))
    rows += [(900 + i, list(rows[0][1]), 0) for i in range(4)]
    rows += [(950, None, 0), (951, [0.0] * 16, 0), (952, [float("nan")] * 16, 0), (953, [float("inf")] + [1.0] * 15, 0), (954, list(rows[0][1]), None), (955, [], 0), (956, [1e-200] * 16, 0), (957, [1e200] * 16, 0), (958, [1.0] * 5, 0), (0, list(rows[0][1]), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as n", "2 as rep", "3 as first")
    near = brute_links(rows)
    label = closure(near | np.eye(len(rows), dtype=bool))
    ids = np.array([r[0] for r in rows])
    want = sorted((int(ids[i]), int(near[i].sum()), int(ids[label == label[i]].min())) for i in range(len(rows)))
    got = rotation.near_duplicates(df, block=16)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())
    assert rotation.near_duplicates(df.limit(0)).count() == 0


def test_bounds_always_hold_and_estimates_are_unbiased():
    rng = np.random.default_rng(7)
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.standard_normal((2, 60, 32)))
    true, estimates = a @ b.T, []
    for seed in range(60):
        bits, correction = rotation.codes(b, seed)
        estimate, low, high = rotation.bounds(a, bits, correction, seed)
        assert (low <= true).all() and (true <= high).all()
        estimates.append(estimate)
    assert np.abs(np.mean(estimates, axis=0) - true).mean() < 0.03


def test_few_pairs_are_recomputed():
    x = np.random.default_rng(8).standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert sum(n for _, _, n in rotation.near_pairs(x, x, 0.93, True)) < 0.02 * 400 * 399 / 2


def words_of(text):
    return [w for w in (re.sub(r"^\W+|\W+$", "", x).lower() for x in (text or "").split()) if w]


ITEM = "A train with 30 miles to go passed Tom Hill and Eva Wood at 77 kmh near Rome, so 30 miles is far from here."


def test_reparameterised_questions(spark):
    docs = [
        (1, "Well. " + ITEM),
        (2, "Well, said he: " + ITEM.replace("30 miles", "45 km").replace("Tom Hill", "Bob Smith").replace("77", "12").replace("Rome", "Paris") + " The end."),
        (3, "Well. " + ITEM.replace("30 miles is", "31 miles is")),
        (4, "Another text that shares near nothing with it, so 30 miles is far from here."),
        (5, None),
        (6, ""),
        (7, ITEM.upper()),
        (8, "x " * 20_000 + ITEM.replace(" ", "\n")),
        (1, "Well. " + ITEM),
        (None, ITEM),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as k", "3 as position")
    items = spark.createDataFrame([(10, ITEM), (11, None), (12, "too short item"), (13, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in templates.contaminated(df, items).collect()}
    caught = {k[0] for k in got}
    assert {1, 2, 8, None} <= caught and not {3, 4, 5, 6} & caught
    assert {i for d, i in got if d == 1} == {10, 13} and got[1, 10].exact and not got[2, 10].exact
    kept = templates.decontaminate(df, items)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {3, 4, 5, 6} and not {1, 2, 8} & {r.doc_id for r in kept.collect()}
    assert templates.contaminated(df.limit(0), items).count() == 0 and templates.decontaminate(df, items.limit(0)).count() == len(docs)


def test_short_items_are_literal_windows(spark):
    docs = spark.createDataFrame([(1, "He said: who wrote War and Peace? I know."), (2, "Who wrote Peace and War"), (3, "WHO WROTE WAR AND"), (4, "only 45 miles here"), (5, "it was only 30 miles, they say"), (6, "Rome"), (7, None), (None, "in 30mi")], "doc_id long, text string")
    items = spark.createDataFrame([(10, "Who wrote War and"), (11, "only 30 miles"), (12, "Rome"), (13, "30 mi"), (14, "Rome"), (16, "30 miles"), (15, "  ")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.matched, r.windows, r.coverage, r.exact) for r in templates.contaminated(docs, items).collect()}
    assert set(got) == {(1, 10), (3, 10), (5, 11), (5, 16), (None, 13)} and set(got.values()) == {(1, 1, 1.0, True)}


def test_items_of_one_template_meet_documents_by_their_rare_windows(spark):
    shared = "According to the table below which of these answers is the right one for"
    rare = [f"word{i} follows alpha{i} and then beta{i} stands after gamma{i}" for i in range(60)]
    items = spark.createDataFrame([(i, f"{shared} {r}") for i, r in enumerate(rare)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"Text {i}. {shared} {rare[i] if i < 20 else 'something else of no item here'}") for i in range(40)], "doc_id long, text string")
    windows = templates.template_windows(items, "item_id", "text", item=True).withColumnsRenamed({"k": "item_id", "position": "item_position", "slots": "item_slots"})
    total = windows.groupBy("item_id").agg(F.countDistinct("item_position").alias("windows"))
    pairs = templates.candidates(templates.template_windows(docs, "doc_id", "text"), windows, total, 0.8)
    assert sorted((r.k, r.item_id) for r in pairs.collect()) == [(i, i) for i in range(20)]
    assert sorted((r.doc_id, r.item_id) for r in templates.contaminated(docs, items).collect()) == [(i, i) for i in range(20)]


def test_decontamination_of_the_tables_equals_plain_windows(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    index, size = {}, {}
    for r in items.collect():
        w = words_of(r.text)
        size[r.item_id] = len(w) - 4
        for k in range(len(w) - 4):
            index.setdefault(tuple(w[k : k + 5]), set()).add((r.item_id, k))
    want = set()
    for r in docs.collect():
        w, met = words_of(r.text), {}
        for k in range(len(w) - 4):
            for i, p in index.get(tuple(w[k : k + 5]), ()):
                met.setdefault(i, set()).add(p)
        want |= {(r.doc_id, i) for i, s in met.items() if len(s) >= 0.8 * size[i]}
    assert {(r.doc_id, r.item_id) for r in templates.contaminated(docs, items).collect()} == want


def test_most_links_are_decided_by_the_code_alone():
    rng = np.random.default_rng(9)
    base = rng.standard_normal((50, 64))
    x = np.concatenate([base, base + 0.02 * rng.standard_normal((50, 64)), base * 3])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = list(rotation.near_pairs(x, x, 0.93, True))
    found = sum(len(a) for a, _, _ in got)
    assert found == ((x @ x.T >= 0.93).sum() - len(x)) // 2 == 150
    assert sum(n for _, _, n in got) < 0.02 * len(x) * (len(x) - 1) / 2 + found


def test_codes_are_stored_packed(spark):
    _, reps = rotation.representatives(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
    r = rotation._coded(reps).first()
    assert len(r.code) == (len(r.e) + 7) // 8 and 0 < r.factor <= 1
