"""Set joins, replay, stored indexes and stores against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import lexical_index, passages, replay, retrieval, set_join, spans, vector_index
from tessera.session import new_folder


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.9, 1.0])
def test_similar_sets_equal_all_pairs(spark, threshold):
    rng = random.Random(int(threshold * 10))
    rows = []
    for i in range(240):
        base = [f"w{rng.randrange(12) if rng.random() < 0.6 else rng.randrange(400)}" for _ in range(rng.randrange(1, 14))]
        rows.append((i, base if i % 5 or not rows else rows[rng.randrange(len(rows))][1]))
    left = spark.createDataFrame([*rows[:120], (900, None), (901, [])], "l long, w array<string>")
    right = spark.createDataFrame([*rows[120:], (900, []), (902, None)], "r long, w array<string>")
    pairs, a, b = set_join.similarity_join(left, "l", F.col("w"), right, "r", F.col("w"), threshold)
    assert "Cartesian" not in pairs._jdf.queryExecution().toString() and "NestedLoop" not in pairs._jdf.queryExecution().toString()
    found = pairs.join(a.withColumnRenamed("set", "left_set"), "left_set").join(b.withColumnRenamed("set", "right_set"), "right_set").collect()
    sets = {i: set(w) for i, w in rows}
    want = {(x, y): jaccard(sets[x], sets[y]) for x in range(120) for y in range(120, 240) if jaccard(sets[x], sets[y]) >= threshold}
    assert {(r.l, r.r): round(r.similarity, 9) for r in found} == {k: round(v, 9) for k, v in want.items()} and len(found) == len(want)


def test_copies_meet_once(spark):
    rows = spark.createDataFrame([(i, ["a", "b", "c"]) for i in range(400)] + [(999, ["a", "b", "d"])], "k long, w array<string>")
    pairs, members, _ = set_join.similarity_join(rows, "k", F.col("w"), rows, "k", F.col("w"), 0.5)
    assert pairs.count() == 4 and members.count() == 401


def test_independence_rules(spark):
    schema = "k long, w array<string>"
    five = ["a", "b", "c", "d", "e"]
    queries = spark.createDataFrame([(1, five), (2, ["e", "d", "c", "b", "a"]), (3, ["a", "b"]), (4, ["b", "a"]), (5, []), (6, None), (None, five), (8, [*"abcdefghij"]), (9, ["a", "a", "b", "b", "c", "c"])], schema)
    others = spark.createDataFrame([(1, five), (2, ["a", "b"]), (3, None), (4, [*"abcdefghi"]), (5, ["a", "b", "c"])], schema)
    got = {r.k: tuple(r)[1:] for r in set_join.independence(queries, "k", F.col("w"), others, F.col("w")).collect()}
    yes = (True, False, False, True)
    assert got == {1: (True, True, True, False), 2: (True, False, True, False), 3: (True, True, False, False), 4: yes, 5: (False, False, False, False), 6: (False, False, False, False), None: (True, True, True, False), 8: (True, False, True, False), 9: yes}


def plain_fold(rows, cap):
    groups, own = [], []
    for doc, section, a, b, start, end in rows:
        chosen = None
        for i, g in enumerate(groups):
            apart = g["end"] < start or end < g["start"]
            if section is not None and (g["doc"], g["section"]) == (doc, section) and not apart and max(b, g["b"]) - min(a, g["a"]) <= cap:
                chosen = i
                break
        if chosen is None:
            groups.append({"doc": doc, "section": section, "a": a, "b": b, "start": start, "end": end})
            chosen = len(groups) - 1
        else:
            g = groups[chosen]
            g.update(a=min(a, g["a"]), b=max(b, g["b"]), start=min(start, g["start"]), end=max(end, g["end"]))
        own.append(chosen)
    return [(i, *(groups[i][k] for k in ("a", "b", "start", "end"))) for i in own]


def test_the_fold_joins_by_rank_under_its_cap():
    assert replay.fold([(1, 0, 0, 10, 0, 50), (1, 0, 10, 20, 50, 90), (1, 0, 21, 30, 91, 120)], 100) == [(0, 0, 20, 0, 90), (0, 0, 20, 0, 90), (1, 21, 30, 91, 120)]  # touching joins, a gap does not
    assert replay.fold([(1, 0, 0, 10, 0, 50), (1, 0, 5, 20, 25, 90), (1, 0, 15, 25, 70, 99)], 20) == [(0, 0, 20, 0, 90), (0, 0, 20, 0, 90), (1, 15, 25, 70, 99)]  # the cap
    assert len({g for g, *_ in replay.fold([(1, 0, 0, 9, 0, 50), (1, 1, 5, 9, 25, 50), (2, 0, 0, 9, 0, 50), (1, None, 0, 9, 0, 50), (1, None, 0, 9, 0, 50)], 99)}) == 5
    rng = random.Random(4)
    for _ in range(300):
        rows = []
        for _ in range(rng.randrange(12)):
            a = rng.randrange(40)
            b = a + rng.randrange(1, 12)
            rows.append((rng.randrange(2), rng.choice([0, 1, None]), a, b, a * 5, b * 5 - 1 + rng.randrange(2)))
        assert replay.fold(rows, 18) == plain_fold(rows, 18)


def test_replay_equals_plain_parents_and_folds(spark):
    rng = random.Random(8)
    texts = {d: "\n\n".join(("Head\n" if i % 3 == 0 else "") + " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(5, 60))) + "." for i in range(rng.randrange(1, 14))) for d in range(6)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kids = passages.chunked(docs, "doc_id", "text", 20, 5, headings=["Head"]).select("doc_id", "chunk_order").collect()
    hits = []
    for q in range(5):
        hits += [(q, k.doc_id, k.chunk_order, i + 1) for i, k in enumerate(rng.sample(kids, 14))]
    df = spark.createDataFrame(hits, "item_id long, doc_id long, chunk_order int, rank int")
    variants = ((30, None), (30, 45), (60, 61))
    got = replay.merged(replay.parents(df, docs, "doc_id", "text", variants=variants, size=20, overlap=5, headings=("Head",)), "item_id", "doc_id", "rank", variants).collect()
    assert len(got) == len(hits) * 3
    layouts = {d: passages.Layout(t, spans.WordTokenizer(), frozenset(["Head"])) for d, t in texts.items()}
    for tokens, cap in variants:
        for q in range(5):
            rows = []
            for _, d, order, _ in sorted((h for h in hits if h[0] == q), key=lambda h: h[3]):
                lay = layouts[d]
                child = passages.children(lay, 20, 5)[order]
                a, b = passages.parent(lay, child, tokens)
                assert b - a <= tokens and a <= child[1] and child[2] <= b
                rows.append((d, child[0], a, b, lay.starts[a], lay.ends[b - 1]))
            want = plain_fold(rows, cap) if cap else [(i, *r[2:]) for i, r in enumerate(rows)]
            mine = sorted((r for r in got if r.item_id == q and r.variant == replay.named(tokens, cap)), key=lambda r: r["rank"])
            assert [(r.parent, r["first"], r["last"], r.start_char, r.end_char) for r in mine] == want


def test_a_parent_must_hold_its_child(spark):
    docs = spark.createDataFrame([(1, "a " * 100)], "doc_id long, text string")
    hits = spark.createDataFrame([(1, 1, 0, 1)], "item_id long, doc_id long, chunk_order int, rank int")
    with pytest.raises(Exception, match="cannot hold"):
        replay.parents(hits, docs, "doc_id", "text", variants=((30, None),), size=60).collect()


def test_the_sweep_orders_variants(spark):
    docs = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(300))), (2, " ".join(f"b{i}" for i in range(300)))], "doc_id long, text string")
    hits = spark.createDataFrame([(7, 1, 1, 1), (7, 1, 2, 2), (7, 2, 0, 3)], "item_id long, doc_id long, chunk_order int, rank int")
    gold = spark.createDataFrame([(7, 1, [f"a{i}" for i in range(20, 60)])], "item_id long, doc_id long, tokens array<string>")
    variants = ((30, None), (120, None), (60, 200))
    got = {r.place: r for r in replay.sweep(hits, docs, gold, "item_id", "doc_id", "text", variants=variants, size=20, overlap=2).collect()}
    assert sorted(got) == [1, 2, 3] and all(r.queries == 1 for r in got.values())
    assert all(got[i].combined_f2 >= got[i + 1].combined_f2 for i in (1, 2))
    assert all(abs(r.document_f2 - 5 / 6) < 1e-6 and abs(r.combined_f2 - (r.document_f2 + r.chunk_f2) / 2) < 2e-6 for r in got.values())  # half the documents right, all gold found
    by = {r.variant: r.chunk_f2 for r in got.values()}
    assert abs(by["parent-120"] - 5 / 6) < 1e-6  # one passage of document 1 after duplicates, one of document 2


def words(t):
    return re.findall(r"\w+", t)


def plain_bm25(docs, terms, k):
    bags = {d: words(t) for d, t in docs}
    n, mean = len(bags), max(1.0, sum(map(len, bags.values())) / len(bags))
    df = {t: sum(t in b for b in bags.values()) for t in terms}
    score = {d: sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * b.count(t) * 2.5 / (b.count(t) + 1.5 * (0.25 + 0.75 * len(b) / mean)) for t in terms if t in b) for d, b in bags.items() if set(b) & terms}
    return sorted(((-round(s, 6), d) for d, s in score.items()))[:k]


def test_the_stored_index_grows_merges_and_equals_the_scan(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(f"t{min(int(rng.expovariate(0.02)), 900)}" for _ in range(rng.randrange(0, 30)))) for i in range(2000)] + [(5000, "")]
    for i in range(0, 2000, 150):  # few documents are far better than the rest
        docs[i] = (i, "rare1 rare2 rare3 " * 3 + docs[i][1])
    rng.shuffle(docs)
    queries = spark.createDataFrame([(0, ["rare1", "rare2", "t3"]), (1, ["t5", "t7", "t5"]), (2, ["absent"]), (3, []), (4, ["t800", "rare3"])], "q long, w array<string>")
    tokens = F.expr("regexp_extract_all(text, '[a-z0-9]+', 0)")
    folder = new_folder(spark, "index")
    lexical_index.create(spark, folder)
    with pytest.raises(FileExistsError):
        lexical_index.create(spark, folder)
    assert lexical_index.search(lexical_index.Index(spark, folder), queries, "q", F.col("w"), 5)[0].count() == 0
    df = spark.createDataFrame(docs, "doc_id long, text string")
    held = []
    for part in (docs[:700], docs[700:1500], docs[1500:]):
        lexical_index.add(spark, folder, spark.createDataFrame(part, df.schema), "doc_id", tokens, block=16)
        held += part
        if len(held) == 1500:
            lexical_index.merge(spark, folder)
            lexical_index.merge(spark, folder)
        index = lexical_index.Index(spark, folder)
        found, blocks = lexical_index.search(index, queries, "q", F.col("w"), 5, "doc_id")
        got = {}
        for r in found.collect():
            got.setdefault(r.q, []).append((-r.score, r.doc_id))
        for q, w in ((0, {"rare1", "rare2", "t3"}), (1, {"t5", "t7"}), (2, {"absent"}), (4, {"t800", "rare3"})):
            want = plain_bm25(held, w, 5)
            mine = sorted(got.get(q, []))
            assert [d for _, d in mine] == [d for _, d in want] and all(abs(a - b) < 2e-6 for (a, _), (b, _) in zip(mine, want, strict=True))
        report = blocks.first()
        assert report.read < 0.8 * report.blocks  # blocks that cannot reach the floor are skipped
    assert len(index.segments) == 2
    with pytest.raises(ValueError):
        lexical_index.add(spark, folder, spark.createDataFrame([docs[3]], df.schema), "doc_id", tokens)
    with pytest.raises(ValueError):
        lexical_index.add(spark, folder, spark.createDataFrame([(None, "a")], df.schema), "doc_id", tokens)
    # what a build that never committed left behind is not read
    spark.range(3).write.parquet(f"{folder}/segment-lost/postings")
    assert lexical_index.Index(spark, folder).documents == len(docs)


def test_passages_of_a_document_in_order(spark):
    rows = [(1, 1, "a", 1, ["x", "y"]), (1, 1, "a", 2, ["q"]), (1, 1, "b", 3, ["x", "y"]), (1, 1, "c", 4, ["z"]), (1, 1, "d", 5, ["u"]), (1, 2, "a", 6, ["x", "y"]), (2, 1, "b", 1, ["x"])]
    df = spark.createDataFrame(rows, "q long, doc long, parent string, ord int, tokens array<string>")
    got = {(r.q, r.place): (r.doc, r.parent) for r in retrieval.select_passages(df, "q", "doc", "parent", "tokens", "ord", 2, 8).collect()}
    assert got == {(1, 1): (1, "a"), (1, 2): (1, "c"), (1, 3): (2, "a"), (2, 1): (1, "b")}


def vectors_around(rng, groups, members, d=16):
    centres = rng.standard_normal((groups, d))
    m = (centres[:, None, :] + 0.4 * rng.standard_normal((groups, members, d))).reshape(-1, d)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_cells_grow_and_recall_holds(spark):
    rng = np.random.default_rng(5)
    m = vectors_around(rng, 300, 100)
    e = spark.createDataFrame([(i, v) for i, v in enumerate(m.tolist())], "vec_id long, embedding array<double>").repartition(8)
    index = vector_index.build(e)
    assert len(index.centres) == vector_index.cells_of(len(m)) == 4 * int(len(m) ** 0.5) > 512 and vector_index.cells_of(10**6) == 4000
    used = index.table.groupBy("cell").count().agg(F.count("*").alias("cells"), F.max("count").alias("most")).first()
    assert used.cells > 0.8 * len(index.centres) and used.most < 40 * len(m) / len(index.centres)
    q = e.where("vec_id % 500 = 0").withColumnRenamed("vec_id", "query_id")
    found, recall, probes = vector_index.gated_search(index, q, e, 10)
    want = np.argsort(-(m[::500] @ m.T), axis=1)[:, :10]
    mine = {}
    for r in found.collect():
        mine.setdefault(r.query_id, set()).add(r.vec_id)
    assert recall >= 0.95 and probes < 64
    assert np.mean([len(mine[i * 500] & set(w.tolist())) / 10 for i, w in enumerate(want)]) >= 0.95


def test_the_coarse_level_finds_the_nearest_cells():
    rng = np.random.default_rng(6)
    centres = vector_index.Centres(vectors_around(rng, 60, 20))
    m = vectors_around(rng, 40, 5)
    near = centres.nearest(m, 8)
    assert near.shape == (200, 8) and all(len(set(r)) == 8 for r in near.tolist())
    exact = np.argsort(-(m @ centres.cells.T), axis=1)[:, :8]
    assert np.mean([len(set(a) & set(b)) / 8 for a, b in zip(near.tolist(), exact.tolist(), strict=True)]) > 0.9
    assert (np.sort(centres.nearest(m, len(centres)), axis=1) == np.arange(len(centres))).all()


def test_probing_goes_on_until_k_are_found(spark):
    e = spark.createDataFrame([(i, [float(i == j) + 0.01 * i for j in range(12)]) for i in range(12)], "vec_id long, embedding array<double>")
    index = vector_index.build(e, cells=12)  # a vector a cell
    q = e.where("vec_id < 3").withColumnRenamed("vec_id", "query_id")
    assert {r["count"] for r in vector_index.candidates(index, q, 40, 2).groupBy("query_id").count().collect()} == {2}
    got = {r.query_id: r["count"] for r in vector_index.search(index, q, e, 7, 1).groupBy("query_id").count().collect()}
    assert got == {0: 7, 1: 7, 2: 7}
    assert {r["count"] for r in vector_index.search(index, q, e, 99, 1).groupBy("query_id").count().collect()} == {12}


def test_vectors_that_are_none_have_no_results(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "TILE", (2, 3))
    good = [(i, [float(i % 3), float(i % 2)]) for i in range(20)]
    bad = [(100, None), (101, [1.0]), (102, [None, 1.0]), (103, [float("nan"), 1.0]), (104, []), (105, [float("inf"), 0.0])]
    e = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").repartition(3)
    q = spark.createDataFrame([(i, v) for i, v in good[1:8] + bad], "query_id long, embedding array<double>")
    got = {}
    for r in retrieval.exact_topk(q, e, 6).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    want = {i: [v for _, v in sorted((-(a[0] * b[0] + a[1] * b[1]), v) for v, b in good)[:6]] for i, a in good[1:8]}
    assert {i: [v for _, v in sorted(x)] for i, x in got.items()} == want
    index = vector_index.build(e)
    assert index.table.count() == 20 and {r.query_id for r in vector_index.search(index, q, e, 6, 1).collect()} == set(range(1, 8))
    assert vector_index.build(e.where("vec_id = 100")).table.count() == 0
    named = e.selectExpr("cast(vec_id as string) as vec_id", "embedding")
    assert retrieval.exact_topk(q, named, 3).count() == 21


def test_passages_below_floor_or_margin_give_their_place(spark):
    rng = random.Random(11)
    rows = [(q, rng.randrange(4), f"p{i}", i, [f"{q}-{i}-{j}" for j in range(4)], 20.0 - 0.7 * i + rng.random() * 3) for q in range(6) for i in range(20)]
    df = spark.createDataFrame(rows, "q long, doc long, parent string, ord int, tokens array<string>, score double")
    got = {}
    for r in retrieval.select_passages(df, "q", "doc", "parent", "tokens", "ord", 3, 5, score="score", minimum=2, margin=4.0, floor=15.0).collect():
        got.setdefault(r.q, []).append((r.place, r.doc, r.parent))
    for q in range(6):
        taken, counts = [], {}
        for _, doc, parent, i, _, s in sorted((r for r in rows if r[0] == q), key=lambda r: r[3]):
            if counts.get(doc, 0) < 3:
                counts[doc] = counts.get(doc, 0) + 1
                taken.append((doc, parent, s))
        best = max(s for _, _, s in taken)
        kept = [(d, p) for i, (d, p, s) in enumerate(taken) if i < 2 or (s >= 15 and s >= best - 4)][:5]
        assert sorted(got[q]) == [(i + 1, d, p) for i, (d, p) in enumerate(kept)]


def test_the_content_type_chooses_the_parser(spark):
    from tessera.functions import markup

    rows = [(1, "<a><p>x  y</p><p>z</p></a>", "text/xml"), (2, "<p>x</p><p>y</p>", None), (3, "x < y", "text/plain"), (4, None, "text/xml"), (5, "<a><p>open", "application/xml"), (6, "<p>h</p>", "text/plain")]
    got = {r.k: (r.parser, r.text) for r in markup.extract(spark.createDataFrame(rows, "k long, b string, t string").withColumn("u", F.lit("u")), "k", "b", "u", "t").collect()}
    assert got == {1: ("xml", "x y\nz"), 2: ("html", "x\ny"), 3: ("plain", "x < y"), 4: ("none", ""), 5: ("html", "open"), 6: ("html", "h")}
