"""Hooks, passages by tokens, the stored index and exact quantiles against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import corpus, hooks, passages, retrieval, spans, vector_index
from tessera.plans import registry
from tessera.sources import tables


def test_encoder_hook_encodes_equal_texts_once_and_uses_the_cache(spark):
    class Counting(hooks.HashingEncoder):
        def encode(self, texts):
            assert "known" not in texts and len(set(texts)) == len(texts)
            return super().encode(texts)

    rows = [(1, "a bb ccc"), (2, "a bb ccc"), (3, None), (4, "known"), (5, "zz " * 500)]
    df = spark.createDataFrame(rows, "k long, t string")
    plain = hooks.HashingEncoder(16)
    cache = spark.createDataFrame([("known", [float(x) for x in plain.encode(["known"])[0]])], "t string, embedding array<double>").selectExpr("sha2(t, 256) as text_sha256", "embedding")
    got = {r.k: r.embedding for r in hooks.encode_texts(df, "k", "t", Counting(16), cache).collect()}
    assert got.keys() == {1, 2, 3, 4, 5}
    for k, t in rows:
        assert np.allclose(got[k], plain.encode([t or ""])[0])
    assert hooks.encode_texts(df.limit(0), "k", "t", plain).count() == 0


def test_a_bad_encoder_is_an_error(spark):
    class Long:
        name = "long"

        def encode(self, texts):
            return np.full((len(texts), 2), 3.0)

    with pytest.raises(Exception, match="unit length"):
        hooks.encode_texts(spark.createDataFrame([(1, "a")], "k long, t string"), "k", "t", Long()).collect()


def test_reranker_and_analyzer_hooks(spark):
    pairs = spark.createDataFrame([("a b", "b c"), ("", "x"), (None, "x"), ("a", None)], "q string, t string")
    assert [r.model_score for r in hooks.rerank(pairs, "q", "t", hooks.OverlapReranker()).collect()] == [0.5, 0.0, None, None]
    rows = spark.createDataFrame([("ﬁne day", "en"), ("病毒", "zh"), (None, "zh")], "text string, lang string")
    got = [r.tokens for r in hooks.analyze(rows, "text", "lang", {"zh": lambda t: [f"<{t}>"]}).collect()]
    assert got == [["fine", "day"], ["病", "毒", "病毒", "<病毒>"], []]


def layouts():
    rng = random.Random(3)
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 9)):
            parts.append(" ".join(rng.choice(["w", "word.", "x!", "longer", "Dr."]) for _ in range(rng.randrange(1, 70))) + rng.choice(["\n\n", "\n", ". "]))
            if rng.random() < 0.3:
                parts.append(f"\nHeading {rng.randrange(3)}\n")
        text = "".join(parts)
        yield text, passages.Layout(text, spans.WordTokenizer(), frozenset(f"Heading {i}" for i in range(3)))


def test_children_and_parents_keep_budgets_and_bounds():
    for text, layout in layouts():
        n = len(layout.starts)
        kids = passages.children(layout, 24, 6)
        assert sorted({t for _, i, j in kids for t in range(i, j)}) == list(range(n))  # no token is lost
        for (s, i, j), after in zip(kids, [*kids[1:], None]):
            first, last = layout.sections[s]
            assert first <= i < j <= last and j - i <= 24
            if after and after[0] == s:
                assert i < after[1] <= j and j - after[1] <= 6
                best = [k for k in range(i + 13, min(i + 24, last) + 1) if layout.ends[k - 1] in layout.paragraphs] or [k for k in range(i + 13, min(i + 24, last) + 1) if layout.ends[k - 1] in layout.sentences]
                assert j == (best[-1] if best else min(i + 24, last))
            a, b = passages.parent(layout, (s, i, j), 64)
            assert first <= a <= i and j <= b <= last and b - a <= 64
            if last - first <= 64:
                assert (a, b) == (first, last)


def test_chunk_rows_are_slices(spark):
    text = "One two three. " * 100 + "\nHeading\n" + "四 五 six! " * 90
    rows = passages.chunked(spark.createDataFrame([(1, text), (2, None), (3, " ")], "k long, t string"), "k", "t", 50, 10, 120, ["Heading"]).collect()
    assert {r.k for r in rows} == {1} and {r.section for r in rows} == {0, 1}
    for r in rows:
        assert r.text == text[r.start_char : r.end_char] and len(r.text.split()) == r.token_count <= 50
        assert r.parent_start <= r.start_char and r.end_char <= r.parent_end and len(text[r.parent_start : r.parent_end].split()) == r.parent_tokens <= 120


def test_quantised_index_finds_what_exact_search_finds(spark, sf_dir):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    q = e.where("vec_id % 50 = 0").selectExpr("vec_id as query_id", "embedding")
    index = vector_index.build(e)
    assert index.table.count() == e.count() and len(index.table.first().code) == 64
    found, recall, _ = vector_index.gated_search(index, q, e, 10)
    exact = {(r.query_id, r.vec_id) for r in retrieval.exact_topk(q, e, 10).collect()}
    assert recall >= 0.95 and len(exact & {(r.query_id, r.vec_id) for r in found.collect()}) >= 0.9 * len(exact)


def test_the_gate_fails_where_no_probe_helps(spark, monkeypatch):
    e = spark.createDataFrame([(i, [float(i == j) for j in range(4)]) for i in range(4)], "vec_id long, embedding array<double>")
    q = e.withColumnRenamed("vec_id", "query_id")
    monkeypatch.setattr(vector_index, "search", lambda *a, **k: spark.createDataFrame([], "query_id long, vec_id long"))
    with pytest.raises(ValueError, match="recall"):
        vector_index.gated_search(vector_index.build(e), q, e, 2)


def test_exact_quantiles(spark):
    rng = random.Random(1)
    rows = [(g, rng.choice([None, rng.random(), 0.5])) for g in "abbccc" for _ in range(37)] + [("d", None)]
    got = {(r.g, r.point): r.quantile for r in corpus.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0, 0.3, 0.5, 1]).collect()}
    for g in "abc":
        values = [v for h, v in rows if h == g and v is not None]
        for p in (0, 0.3, 0.5, 1):
            assert got[g, p] == pytest.approx(np.quantile(values, p))
    assert ("d", 0.5) not in got


def test_damaged_parts_are_not_read(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(f"file://{tmp_path}/t")
    digests = tables.part_digests(spark, [f"file://{tmp_path}/t/*.parquet"])
    assert tables.read_checked(spark, f"file://{tmp_path}/t", digests).count() == 10
    with pytest.raises(ValueError, match="differ"):
        tables.read_checked(spark, f"file://{tmp_path}/t", {n: "0" * 64 for n in digests})


def test_expansions_of_each_kind(spark, sf_dir):
    rows = registry.queries()["expansion_checks"](spark, sf_dir).collect()
    kinds = {k: {r.problems for r in rows if r.item_id % 4 == k} for k in range(4)}
    assert kinds[0] == {""} and all("" not in kinds[k] for k in (1, 2, 3))


def test_mined_negatives_are_no_positives_and_short_queries_are_held(spark):
    from tessera.operators import evaluation

    gold = [(1, "a b c d e".split()), (2, ["x"])]
    rows = [(1, "near", "c0", 1, "a b c d z".split()), (1, "far", "c0", 2, "q w e r t".split()), (1, "other", "c1", 3, "a q w e r".split()), (1, "empty", "c1", 4, []), (2, "y", "c0", 1, ["y"]), (3, "n", "c0", 1, ["n"]), (3, "m", "c1", 2, ["m"])]
    c = spark.createDataFrame(rows, "q long, k string, cat string, rank int, w array<string>")
    g = spark.createDataFrame(gold, "q long, w array<string>")
    got = {(r.q, r.k): r.held for r in evaluation.mined_negatives(c, g, "q", "k", "cat", "rank", "w", {"c0": 1, "c1": 1}, 2).collect()}
    assert got == {(1, "far"): False, (1, "other"): False, (2, "y"): True, (3, "n"): False, (3, "m"): False}


def test_audits_name_each_fault_once(spark):
    from tessera.operators import audits

    sha = "a" * 64
    said = '{{"status":"SUCCESS_RAW","snapshot_id":"s1","raw_sha256":"{}","fetch_url":"{}"}}'
    sound = lambda i: (i, f"u{i}", f"raw/{i}", sha, 5, said.format(sha, f"u{i}"), "s1", "s2", "EXTRACT_SUCCESS")
    swapped = lambda i, **kw: tuple(kw.get(c, v) for c, v in zip(("id", "fetch", "path", "sha", "size", "json", "old", "new", "state"), sound(i)))
    raw = spark.createDataFrame(
        [sound(1), sound(1), swapped(2, path=None), swapped(3, path="raw/a\\b"), swapped(4, sha=sha + "\n"), swapped(5, size=None), swapped(6, json="{"), swapped(7, json=None), swapped(8, new=None), sound(9)],
        "crawl_url_id long, fetch_url string, raw_path string, raw_sha256 string, raw_size_bytes long, original_crawl_record_json string, original_snapshot_id string, new_snapshot_id string, extract_status string",
    )
    mapping = spark.createDataFrame([(i, i, f"u{i}#x") for i in range(1, 9)] + [(8, 8, "u8#x"), (20, 20, "u20"), (None, None, None)], "doc_id long, crawl_url_id long, original_url string")
    official = spark.createDataFrame([(i, f"u{i}#x") for i in range(1, 9)] + [(30, "u2#y"), (20, "other")], "id long, url string")
    existing = spark.createDataFrame([(1, "u1#x"), (2, "else"), (2, None)], "doc_id long, url string")
    got = {r.check: r.violations for r in audits.retained_crawl(mapping, raw, official, existing, "s2", "s1").collect()}
    assert got == {
        "duplicate_mapping_id": 2, "duplicate_raw_id": 1, "unmapped_native_id": 2, "mapping_missing_raw": 2, "raw_outside_mapping": 1, "native_url_conflict": 2,
        "fetch_url_mismatch": 0, "invalid_raw_locator": 2, "invalid_raw_metadata": 2, "invalid_original_crawl": 3, "snapshot_mismatch": 1, "missing_official_alias": 1,
    }
    done = spark.createDataFrame([(2, "s1", sha, "EXTRACT_SUCCESS", "ab", 2), (2, "s1", sha, "EXTRACT_SUCCESS", " ", 1), (3, None, sha, "EXTRACT_SUCCESS", None, None), (99, "s1", sha, "EXTRACT_SUCCESS", "a", 1), (9, "s1", sha, None, "a", 2)], "crawl_url_id long, snapshot_id string, raw_sha256 string, extract_status string, text string, char_count long")
    got = {r.check: r.violations for r in audits.retained_extraction(raw, done).collect()}
    assert got == {"duplicate_extraction": 1, "invalid_source_length": 3, "extraction_binding": 3, "missing_successful_extraction": 7}
    none = audits.retained_crawl(mapping.limit(0), raw.limit(0), official.limit(0), existing.limit(0), "s2", "s1").collect()
    assert len(none) == 12 and not any(r.violations for r in none)


def test_exclusions_in_order_and_without_values(spark):
    from tessera.operators import audits

    payload = "Ab1+xYz9Qr7LmN0pTt4Vw/Kc2Hg5Jd8SeUf6BiOa3" * 5
    rows = [("404 Not Found", payload, "https://e.org/a", "https://e.org/"), ("404 Not Found", "x", "https://e.org/a", "https://e.org/"), ("404 Not Found", "x", "https://e.org/", "https://e.org/"), ("A title", "x", "https://e.org/a", "https://e.org/?q=1"), (None, None, None, None), (None, "Just a moment...\nx", None, "https://e.org/"), ("", "", "", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, title string, text string, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(audits.exclusion_reason(F.col("title"), F.col("text"), F.col("a"), F.col("b"))).collect()]
    assert got == ["ENCODED_PAYLOAD_REVIEW", "ARTICLE_REDIRECTED_TO_HOMEPAGE", "NOT_FOUND_PAGE", None, None, "BOT_CHALLENGE", None]


def test_ablations_and_gate_equal_a_plain_fusion(spark):
    import random

    from tessera.operators import audits

    rng = random.Random(3)
    legs = [(q, d, b, r + 1) for q in range(6) for b in "xyz" for r, d in enumerate(rng.sample(range(12), 6))]
    gold = [(q, rng.randrange(12)) for q in range(6) for _ in range(2)] + [(9, 1)]
    variants = {"full": {"x": 1.0, "y": 0.5, "z": 0.2}, "no_x": {"x": 0, "y": 0.5, "z": 0.2}, "y": {"y": 1.0}, "none": {"w": 1.0}}

    def plain(weights):
        out = []
        for q in sorted({q for q, _ in gold}):
            score = {}
            for a, d, b, r in legs:
                if a == q and weights.get(b, 0) > 0:
                    score[d] = score.get(d, 0) + weights[b] / (60 + r)
            top = sorted(score, key=lambda d: (-round(score[d], 6), d))[:3]
            want = {d for a, d in gold if a == q}
            p, r = len(want & set(top)) / len(top) if top else 0, len(want & set(top)) / len(want)
            out.append(5 * p * r / (4 * p + r) if p + r else 0)
        return sum(out) / len(out)

    got = audits.ablations(spark.createDataFrame(legs, "q int, d int, branch string, rank int"), variants, spark.createDataFrame(gold, "q int, d int"), "q", "d", 3, "full").collect()
    want = {v: plain(w) for v, w in variants.items()}
    assert {r.variant: (r.queries, r.f2, r.change) for r in got} == {v: (7, pytest.approx(f, abs=1e-6), pytest.approx(f - want["full"], abs=2e-6)) for v, f in want.items()}
    side = lambda rows: spark.createDataFrame(rows, "slice string, value string, f2 double")
    gate = audits.slice_gate(side([("l", "en", 0.5), ("l", "de", 0.5), ("l", "fr", 0.1)]), side([("l", "en", 0.495), ("l", "de", 0.4), ("l", "es", 1.0)]), 0.01)
    assert {(r.value, r.passed) for r in gate.collect()} == {("en", True), ("de", False), ("fr", False), ("es", False)}
