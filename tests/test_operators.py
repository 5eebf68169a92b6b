"""Operators against brute force, properties and edge cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import markup, text, urls
from tessera.operators import corpus, evaluation, intake, retrieval, spans
from tessera.operators.components import connected_components
from tessera.plans import registry
from tessera.sources import tables
from tessera.streaming import ingest as stream


def lcs_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(0, 3), max_size=25))
def test_lcs_by_bits_equals_the_table(a, b):
    assert retrieval.lcs_length(a, b) == lcs_table(a, b)


def test_lcs_similarity_edges():
    assert retrieval.lcs_similarity([], []) == 1.0
    assert retrieval.lcs_similarity([1, 2], [1, 2]) == 1.0
    assert retrieval.lcs_similarity([1], []) == 0.0


def test_bm25_micro_case(spark):
    docs = spark.createDataFrame([(0, "HbA1c"), (1, "HbA1c diabetes"), (2, "病毒感染")], "id int, text string")
    ask = lambda t: {r.id: r.score for r in retrieval.bm25(spark.createDataFrame([(9, t)], "q int, text string"), "q", text.lexical_tokens(F.col("text")), docs, "id", text.lexical_tokens(F.col("text"))).collect()}
    s = ask("HbA1c")
    assert s[0] > s[1] > 0 and 2 not in s
    assert ask("absent") == {}
    assert list(ask("感染")) == [2]


def test_tokens_of_cjk_runs_and_folding(spark):
    row = spark.createDataFrame([("Straße 病毒感 x_1",)], "t string").select(text.lexical_tokens(F.col("t")).alias("w")).first()
    assert row.w == ["strasse", "病", "毒", "感", "病毒", "毒感", "x", "1"]


def test_rrf_micro_case_and_duplicates(spark):
    rows = [("q", "dense", 1, 1, 0.9), ("q", "dense", 2, 2, 0.8), ("q", "vi", 2, 1, 3.0)]
    df = spark.createDataFrame(rows, "q string, branch string, id int, rank int, score double")
    got = {r.id: r.score for r in retrieval.weighted_rrf(df, "q", "id", {"dense": 1.0, "vi": 0.8}).collect()}
    assert got[2] == pytest.approx(1 / 62 + 0.8 / 61) and got[2] > got[1]
    with pytest.raises(Exception, match="twice"):
        retrieval.weighted_rrf(df.unionByName(df.limit(1)), "q", "id", {"dense": 1.0, "vi": 0.8}).collect()


def test_cutoff_keeps_later_rows_that_pass(spark):
    df = spark.createDataFrame([("q", i, s) for i, s in enumerate([0.9, 0.1, 0.5, 0.2, 0.8])], "q string, rank int, s double")
    got = lambda **k: [r.rank for r in retrieval.cutoff(df, "q", "rank", "s", **k).orderBy("rank").collect()]
    assert got(minimum=1, maximum=5, floor=0.5) == [0, 2, 4]
    assert got(minimum=2, maximum=3, floor=0.5) == [0, 1, 2]
    assert got(minimum=0, maximum=5, margin=0.1) == [0, 4]


def test_exact_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    m = rng.standard_normal((200, 8)).round(1)
    v = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "vec_id long, embedding array<double>")
    q = v.where("vec_id < 7").withColumnRenamed("vec_id", "query_id")
    got = {(r.query_id, r["rank"]): r.vec_id for r in retrieval.exact_topk(q, v.repartition(5), 6).collect()}
    for i in range(7):
        best = sorted(range(200), key=lambda j: (-round(float(m[i] @ m[j]), 6), j))[:6]
        assert [got[i, k + 1] for k in range(6)] == best


def test_exact_topk_in_turns(spark):
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "vec_id long, embedding array<double>")
    q = v.withColumnRenamed("vec_id", "query_id")
    assert retrieval.exact_topk(q, v, 2, most=5).count() == 40
    assert retrieval.exact_topk(q.limit(0), v, 2).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    nodes = list(range(300))
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {n: find(n) for e in edges for n in e if e[0] != e[1]} | {n: find(n) for n in got}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.!? \n。Dr", max_size=60))
def test_sentences_tile_the_text(t):
    got = spans.sentence_spans(t)
    assert all(a < b for a, b in got) and all(x[1] <= y[0] for x, y in zip(got, got[1:]))
    covered = {i for a, b in got for i in range(a, b)}
    assert all(c.isspace() for i, c in enumerate(t) if i not in covered)


def test_sentences_stop_at_no_abbreviation():
    t = "Dr. Lee left, e.g. at noon. J. Doe stayed! 真的吗？是。 End"
    assert [t[a:b] for a, b in spans.sentence_spans(t)] == ["Dr. Lee left, e.g. at noon.", "J. Doe stayed!", "真的吗？", "是。", "End"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n", max_size=40))
def test_paragraphs_hold_all_but_space(t):
    got = spans.paragraph_spans(t)
    assert all(t[a:b] == t[a:b].strip() and "\n\n" not in t[a:b] for a, b in got)
    covered = {i for a, b in got for i in range(a, b)}
    assert all(c.isspace() for i, c in enumerate(t) if i not in covered)


def test_token_windows_overlap_and_slice(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}." if i % 9 == 8 else f"w{i}" for i in range(100))), (2, ""), (3, None)], "id int, t string")
    rows = spans.token_windows(docs, "id", "t", 20, 5).orderBy("chunk_order").collect()
    whole = docs.first().t
    assert {r.id for r in rows} == {1} and all(whole[r.start_char : r.end_char] == r.text for r in rows)
    assert all(r.token_end - r.token_start <= 20 for r in rows) and rows[-1].token_end == 100
    assert all(b.token_start < a.token_end for a, b in zip(rows, rows[1:]))


def test_fixed_windows_cover(spark):
    rows = spans.windows(spark.createDataFrame([(1, "x" * 950), (2, "é🎉" * 3), (3, "")], "id int, t string"), "id", "t", 500, 400).collect()
    assert sorted((r.id, r.start_char, r.end_char) for r in rows) == [(1, 0, 500), (1, 400, 900), (1, 800, 950), (2, 0, 6)]


def test_positions_are_dense(spark):
    ids = random.Random(3).sample(range(10**6), 500)
    got = corpus.positions(spark.createDataFrame([(i,) for i in ids], "id long"), "id", partitions=7).collect()
    assert {r.id: r.position for r in got} == {x: i for i, x in enumerate(sorted(ids))}


def test_f2_and_chunk_metrics(spark):
    docs = evaluation.document_metrics(spark.createDataFrame([(1, 5), (1, 6), (2, 9)], "q int, d int"), spark.createDataFrame([(1, 5), (2, 7)], "q int, d int"), "q", "d")
    assert {r.q: round(r.f2, 6) for r in docs.collect()} == {1: round(5 * 0.5 / 3, 6), 2: 0.0}
    p = spark.createDataFrame([(1, 5, ["a", "b"], 1), (1, 5, ["a", "b"], 2), (1, 6, ["a", "b"], 3)], "q int, d int, w array<string>, place int")
    g = spark.createDataFrame([(1, 5, ["a", "b"])], "q int, d int, w array<string>")
    row = evaluation.chunk_metrics(p, g, "q", "d", "w").first()
    assert (row.precision, row.recall) == (0.5, 1.0)


def test_passages_are_chosen_in_order(spark):
    rows = [(1, 1, "a", ["x", "y"], 1), (1, 1, "b", ["x", "y"], 2), (1, 1, "c", ["p", "q"], 3), (1, 1, "d", ["r"], 4), (1, 2, "e", ["x", "y"], 5)]
    df = spark.createDataFrame(rows, "q int, d int, p string, w array<string>, rank int")
    assert [r.p for r in retrieval.select_passages(df, "q", "d", "p", "w", "rank", 2, 8).orderBy("place").collect()] == ["a", "c", "e"]


def test_packing_skips_what_does_not_fit(spark):
    df = spark.createDataFrame([(0, 1, 6), (0, 2, 5), (0, 3, 4)], "w int, id int, n int")
    assert {r.id: r.taken for r in intake.pack_by_budget(df, "w", "id", "n", 10).collect()} == {1: True, 2: False, 3: True}
    got = intake.token_batches(df, "w", "id", "n", 10).collect()
    assert {r.id: r.batch for r in got} == {3: 0, 2: 0, 1: 1}


def test_urls(spark):
    rows = [("https://A.org/x/y.PDF?q=1#f", "a.org"), ("https://u:p@a.org/", None), ("ftp://a.org/", None), (None, None), ("http:///x", None)]
    got = spark.createDataFrame(rows, "u string, h string").select("h", urls.strict_host(F.col("u")).alias("g"), urls.extension(F.col("u")).alias("e")).collect()
    assert all(r.h == r.g for r in got) and got[0].e == "pdf"
    home = lambda a, b: spark.range(1).select(urls.redirected_home(F.lit(a), F.lit(b)).alias("r")).first().r
    assert home("http://a.org/x", "http://a.org/") and not home("http://a.org/", "http://a.org/") and not home("http://a.org/x", "http://a.org/?id=3")


def test_markup():
    got = markup.extract_source("<html><head><title>T &amp; U</title><script>no</script></head><body><nav>menu</nav><h2>Head</h2><p>One<br>two</p><table><tr><td>a</td><td>b</td></tr></table></body></html>")
    assert got == {"title": "T & U", "text": "Head\nOne\ntwo\na | b", "headings": ["Head"], "parser": "html"}
    xml = markup.extract_source("<article><front><article-title>Z</article-title></front><body><p>病毒 <i>x</i></p></body></article>", "application/xml")
    assert xml["title"] == "Z" and xml["text"] == "Z\n病毒 x"
    assert markup.extract_source(None)["text"] == "" and markup.extract_source("just words", "text/plain")["parser"] == "plain"


def test_tables_are_confined_checked_and_written_once(spark, tmp_path):
    root = f"file://{tmp_path}"
    with pytest.raises(ValueError):
        tables.confined("/data", ["../x"])
    df = spark.range(5)
    tables.publish(df, f"{root}/t")
    assert spark.read.parquet(f"{root}/t").count() == 5
    with pytest.raises(FileExistsError):
        tables.publish(df, f"{root}/t")
    (tmp_path / "f").write_bytes(b"abc")
    import hashlib

    assert tables.damaged_parts(spark, str(tmp_path), {"f": hashlib.sha256(b"abc").hexdigest()}).count() == 0
    assert tables.damaged_parts(spark, str(tmp_path), {"f": "0"}).count() == 1
    with pytest.raises(ValueError):
        tables.require_columns(df, {"id": "string"})
    with pytest.raises(ValueError):
        tables.expect_unique(df.union(df), "id")
    tables.write_ordered_parts(df, f"{root}/o", "id", parts=2)
    tables.export_csv(df, f"{root}/c")
    assert spark.read.option("header", True).csv(f"{root}/c").count() == 5


def test_pending_rejects_another_policy(spark):
    items, done = spark.range(4), spark.createDataFrame([(1, "s")], "id long, signature string")
    assert [r.id for r in stream.pending(items, done, "id", "s").orderBy("id").collect()] == [0, 2, 3]
    with pytest.raises(ValueError):
        stream.pending(items, done, "id", "t")


def test_submission_rows(spark):
    p = spark.createDataFrame([(7, 3, "b", 2), (7, 3, "a", 1), (7, 1, "c", 3)], "q int, doc_id int, t string, place int")
    r = tables.submission(p, "q", "doc_id", "t").first()
    assert r.relevant_docs == [3, 1] and [c.chunk_text for c in r.relevant_chunks] == ["a", "b", "c"]


def test_positions_with_carried_columns_are_dense(spark):
    rows = spark.range(0, 1_000_000, numPartitions=60).selectExpr("pmod(xxhash64(id), 1000000007) * 1000000 + id as k", "repeat('x', 20) as text", "id % 7 as g")
    got = corpus.positions(rows, "k", partitions=200).selectExpr("count(distinct position) as n", "max(position) as top", "min(position) as low").first()
    assert (got.n, got.low, got.top) == (1_000_000, 0, 999_999)


def test_long_names_are_found(spark):
    glossary = spark.createDataFrame([("a", "high blood pressure of pregnancy"), ("a", "preeclampsia"), ("b", "flu")], "entry string, alias string")
    q = spark.createDataFrame([(1, "What is High blood pressure of pregnancy?"), (2, "the flu"), (3, "blood pressure"), (4, None)], "q long, t string")
    got = {r.q: r.aliases for r in retrieval.with_aliases(q, "q", "t", glossary).collect()}
    assert got == {1: ["high blood pressure of pregnancy", "preeclampsia"], 2: ["flu"]}


def test_splits_keep_duplicates_together(spark, sf_dir):
    rows = registry.queries()["group_splits"](spark, sf_dir).collect()
    of = {}
    for r in rows:
        of.setdefault(r.group, set()).add(r.split)
    assert all(len(x) == 1 for x in of.values()) and len(of) < len(rows)


def test_document_cutoff_of_passages(spark):
    rows = [(1, d, f"{d}{i}", [f"w{d}{i}"], r) for r, (d, i) in enumerate([("a", 0), ("b", 0), ("c", 0), ("a", 1), ("c", 1)])]
    df = spark.createDataFrame(rows, "q long, d string, p string, w array<string>, rank int")
    got = retrieval.select_passages(df, "q", "d", "p", "w", "rank", 2, 8, documents=2).orderBy("place").collect()
    assert [(r.p, r.place) for r in got] == [("a0", 1), ("b0", 2), ("a1", 3)]
