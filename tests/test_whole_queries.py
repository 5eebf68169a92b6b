"""Queries over whole tables, against brute force or counts of their input."""

import math
import re
from collections import Counter

from tessera.plans import registry


def run(spark, sf_dir, name):
    return registry.queries()[name](spark, sf_dir)


def words(t):
    return re.findall(r"[^\W_]+", t.lower())


def small_tables(spark, folder, docs, items):
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_bm25_of_every_item_equals_brute_force(spark, tmp_path):
    docs = [(i * 7, " ".join(f"w{(i * j) % 11}" for j in range(1, 4 + i % 5))) for i in range(60)]
    items = [(i * 50, f"w{i % 11} w{(i * 3) % 11}") for i in range(14)]
    sf_dir = small_tables(spark, tmp_path, docs, items)
    bags = {d: Counter(words(t)) for d, t in docs}
    mean, n = sum(sum(b.values()) for b in bags.values()) / len(bags), len(bags)
    df = Counter(t for b in bags.values() for t in b)
    got = {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in run(spark, sf_dir, "bm25_topk").collect()}
    want = {}
    for q, t in items:
        score = lambda b: sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.5 / (b[w] + 1.5 * (0.25 + 0.75 * sum(b.values()) / mean)) for w in set(words(t)))  # noqa: E731, B023
        best = sorted(((-round(score(b), 6), d) for d, b in bags.items() if any(w in b for w in words(t))))[:20]
        want |= {(q, i + 1): (d, -s) for i, (s, d) in enumerate(best)}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)
    far = {(r.item_id, r.doc_id) for r in run(spark, sf_dir, "bm25_local").collect()}
    assert far == {(q, d) for q, t in items for d, b in bags.items() if set(words(t)) & set(b)}
    assert {r.item_id for r in run(spark, sf_dir, "bm25_fielded").collect()} == {q for q, _ in items}


def test_every_item_gets_passages(spark, sf_dir):
    items = {r.item_id for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    assert {r.item_id for r in run(spark, sf_dir, "select_parents").collect()} == items
    assert {r.item_id for r in run(spark, sf_dir, "chunk_f2").collect()} == items


def test_lcs_of_every_neighbouring_pair(spark, tmp_path):
    docs = [(1, " ".join(f"w{i * i % 37}" for i in range(900))), (2, "short one"), (3, " ".join(f"v{i % 5}" for i in range(300)))]
    sf_dir = small_tables(spark, tmp_path, docs, [])
    want = {}
    for d, t in docs:
        parts = [words(t[s : s + 500]) for s in range(0, len(t), 400) if s == 0 or s + 100 < len(t)]
        for i, (a, b) in enumerate(zip(parts, parts[1:])):
            row = [0] * (len(b) + 1)
            for x in a:
                new = [0]
                for j, y in enumerate(b):
                    new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
                row = new
            want[d, i] = (len(a), len(b), row[-1])
    got = {(r.doc_id, r.chunk_order): (r.n1, r.n2, r.common) for r in run(spark, sf_dir, "lcs_similarity").collect()}
    assert len(want) > 5 and got == want


def test_ranking_reaches_every_document_and_vector(spark, tmp_path, sf_dir):
    docs = [(i * 100, "line of words\n" * (3 * i + 1)) for i in range(1, 40)]
    small = small_tables(spark, tmp_path, docs, [])
    assert {r.doc_id for r in run(spark, small, "centred_parents").collect()} == {d for d, _ in docs}
    kept = {}
    for r in run(spark, small, "suppressed_overlaps").collect():
        kept.setdefault(r.doc_id, []).append(r)
    assert kept.keys() == {d for d, _ in docs}
    for d, t in docs:
        starts = [s for s in range(0, len(t), 400) if s == 0 or s + 100 < len(t)]
        assert len(kept[d]) == min(2, len(starts))
    rows = run(spark, sf_dir, "rerank_orders").collect()
    n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id % 50 = 0").count()
    assert len(rows) == 60 * n and any(r.vec_id >= 60 for r in rows)


def test_filters_drop_no_row(spark, tmp_path, sf_dir):
    count = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count()
    assert run(spark, sf_dir, "eligibility").count() == count("documents")
    assert run(spark, sf_dir, "vector_agreement").first()["rows"] == count("embeddings")
    returned = {r.l_orderkey for r in spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_returnflag = 'R'").collect()}
    orders = {r.o_orderkey for r in spark.read.parquet(f"{sf_dir}/orders.parquet").collect()}
    assert {r.o_orderkey for r in run(spark, sf_dir, "missing_outcomes_anti").collect()} == orders - returned
    docs = [(1, "a | b\nc"), (2, " plain \nx"), (3, "c\na|b")]
    small = small_tables(spark, tmp_path, docs, [])
    assert {r.doc_id: r.hints for r in run(spark, small, "heading_hints").collect()} == {1: ["a | b"], 2: ["plain"], 3: ["c"]}


def test_rescored_candidates_are_each_querys_own(spark, sf_dir):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    rows = run(spark, sf_dir, "candidate_rescore").collect()
    assert {r.query_id for r in rows} == {k for k in vectors if k % 50 == 0}
    assert len(rows) == 10 * len({r.query_id for r in rows}) and len({r.vec_id for r in rows}) > 10
    for r in rows:
        assert abs(r.score - sum(a * b for a, b in zip(vectors[r.query_id], vectors[r.vec_id]))) < 1e-5
