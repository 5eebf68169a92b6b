"""Stores, ordered work, host rules and sketches against brute force."""

import bisect
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import site_rules
from tessera.operators import corpus, hooks, ordered, sketches
from tessera.session import new_folder
from tessera.sources import stores
from tessera.sources.manifests import Conflict, Manifest


def test_manifests_are_versions(spark):
    folder = new_folder(spark, "manifest")
    m = Manifest(spark, folder)
    assert m.load() == (0, None)
    assert m.commit(0, {"a": 1}) == 1 and m.commit(1, {"a": "é"}) == 2
    assert Manifest(spark, folder).load() == (2, {"a": "é"}) and m.load(1) == (1, {"a": 1})
    with pytest.raises(Conflict):
        m.commit(1, {"a": 3})
    assert m.load() == (2, {"a": "é"})


def test_the_vector_store_encodes_what_is_new(spark, monkeypatch):
    encoder, folder = hooks.HashingEncoder(16), new_folder(spark, "vectors")
    store = stores.VectorStore.create(spark, folder, encoder.name)
    rows = spark.createDataFrame([(i, f"text {i % 30}") for i in range(90)] + [(99, None), (98, "")], "k long, t string")
    assert store.add(rows.where("k < 10"), "k", "t", encoder) == 10
    with monkeypatch.context() as patch:  # a run that dies before its commit
        patch.setattr(Manifest, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            stores.VectorStore(spark, folder).add(rows, "k", "t", encoder)
    store = stores.VectorStore(spark, folder)
    assert len(store.state["blocks"]) == 1 and store.vectors().count() == 10
    assert store.add(rows, "k", "t", encoder) == 21 and store.add(rows, "k", "t", encoder) == 0
    assert [b["rows"] for b in store.state["blocks"]] == [10, 21]
    old = stores.VectorStore(spark, folder)
    for s in (store, old):
        got = {r.k: r.embedding for r in s.lookup(spark.createDataFrame([*map(tuple, rows.collect()), (777, "unknown")], rows.schema), "k", "t").collect()}
        assert len(got) == 93 and got[777] is None and all(abs(x - y) < 1e-12 for x, y in zip(got[5], encoder.encode(["text 5"])[0]))
        s is store and store.compact()
    assert len(store.state["blocks"]) == 1 and store.vectors().count() == 31
    with pytest.raises(Conflict):
        old.compact()  # someone else committed first
    with pytest.raises(ValueError):
        store.add(rows, "k", "t", hooks.HashingEncoder(8))
    plan = store.lookup(rows.limit(1), "k", "t")._jdf.queryExecution().executedPlan().toString()
    assert "prefix" in plan


def test_deltas_equal_one_batch_and_touch_what_they_must(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, "en", "de"]), None if rng.random() < 0.05 else f"c{rng.randrange(80)}") for i in range(400)]
    rng.shuffle(rows)
    folder = new_folder(spark, "representatives")
    table = stores.Representatives.create(spark, folder, "k long, lang string", buckets=16)
    files = []
    for number in range(8):
        part = rows[number * 50 : number * 50 + 50] if number < 7 else [(1000, "fr", "c3")]
        df = spark.createDataFrame(part, "k long, lang string, content string")
        assert table.merge(df, "content", number) and not table.merge(df, "content", number)
        files.append(dict(table.state["files"]))
    done = rows[:350] + [(1000, "fr", "c3")]
    want = {}
    for k, lang, c in sorted(done, key=lambda r: r[0]):
        if c is not None:
            h = hashlib.sha256(c.encode()).hexdigest()
            first = want.setdefault(h, [k, lang, 0])
            first[2] += 1
    again = stores.Representatives(spark, folder)
    assert {r.content_hash: [r.k, r.lang, r.aliases] for r in again.table().collect()} == want
    changed = [b for b in files[-1] if files[-1][b] != files[-2].get(b)]
    assert changed == [str(int(hashlib.sha256(b"c3").hexdigest()[:8], 16) % 16)]
    assert again.state["cursor"] == 1000
    tail = again.tail(spark.createDataFrame([(999, "x"), (1000, "x"), (1001, "x")], "k long, lang string"))
    assert [r.k for r in tail.collect()] == [1001]
    assert again.merge(spark.createDataFrame([], "k long, lang string, content string"), "content", 50) and again.state["cursor"] == 1000


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_ranges_hand_on_their_edge(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rng = random.Random(3)
        rows, at = [], 0
        for i in range(300):
            n = rng.randrange(1, 9)
            rows.append((i % 3 if i else None, at, n))
            at += n + rng.choice([0, 0, 0, 2, -1])
        df = spark.createDataFrame(rows, "g int, first long, n long")
        for by in ([], ["g"]):
            got = sorted(tuple(-1 if v is None else v for v in r) for r in ordered.following(df, "first", "n", by).select("g", "first", "n", "expected").collect())
            last, want = {}, []
            for g, a, n in sorted(rows, key=lambda r: (r[1], r[2])):
                key = g if by else 0
                want.append(tuple(-1 if v is None else v for v in (g, a, n, last.get(key))))
                last[key] = a + n
            assert got == sorted(want)
        assert ordered.following(df.limit(0), "first", "n").count() == 0
        faults = {tuple(r) for r in ordered.range_faults(df, "first", "n", 0, at + 5).collect()}
        plain, end = set(), 0
        for _, a, n in sorted(rows, key=lambda r: (r[1], r[2])):
            if a != end:
                plain.add(("gap" if a > end else "overlap", a, end))
            end = a + n
        top = max(a + n for _, a, n in rows)
        assert faults == plain | {("short", top, at + 5)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_positions_are_dense_at_any_number_of_partitions(spark):
    rows = spark.createDataFrame([(i * 37 % 501, f"v{i}") for i in range(501)], "k long, v string")
    for n in (1, 3, 50):
        got = sorted((r.position, r.k, r.v) for r in corpus.positions(rows, "k", partitions=n).collect())
        assert [p for p, _, _ in got] == list(range(501)) == [k for _, k, _ in got]
        assert all(v == f"v{i}" for (_, k, v) in got for i in [next(i for i in range(501) if i * 37 % 501 == k)])


def test_runs_are_merged_and_their_faults_named(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    records = [(0, 1, "a", sha("a")), (0, 2, "b", sha("x")), (1, 2, "b", sha("b")), (1, 1, "a2", sha("a2")), (2, 3, None, sha("c")), (2, 4, "d", None), (1, 5, "e", sha("e")), (2, 5, "e", sha("e"))]
    parts = [(0, 0, 2), (1, 3, 2), (2, 4, 4)]
    faults, best = ordered.merged_runs(spark.createDataFrame(records, "run int, doc_id long, body string, sha string"), spark.createDataFrame(parts, "run int, first long, n long"), "doc_id", "run", "first", "n", "body", "sha")
    assert sorted(tuple(r) for r in faults.collect()) == sorted([("gap", "1", "3"), ("overlap", "2", "4"), ("damaged", "0", "2"), ("damaged", "2", "3"), ("damaged", "2", "4"), ("duplicate", "1", "1"), ("duplicate", "2", "5")])
    assert sorted((r.doc_id, r.run, r.body) for r in best.collect()) == [(1, 0, "a"), (2, 1, "b"), (5, 1, "e")]


def plain_tree(rows, leaf):
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    count = {}
    for row in rows:
        h = digest(",".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))
        count[h] = count.get(h, 0) + 1
    depth = 0
    while len(count) > leaf * 16**depth:
        depth += 1
    nodes = {}
    for h, n in count.items():
        nodes.setdefault(h[:depth], []).append(f"{h}:{n}")
    nodes = {k: digest("\n".join(sorted(v))) for k, v in nodes.items()}
    for level in range(depth - 1, -1, -1):
        above = {}
        for k, d in nodes.items():
            above.setdefault(k[:level], []).append(f"{k}:{d}")
        nodes = {k: digest("\n".join(sorted(v))) for k, v in above.items()}
    return nodes.get("", digest(""))


def test_one_digest_whatever_the_partitions(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, i]), rng.choice([None, "", "a,b", "é\n", f"t{i}"]), "same" if i % 3 else None) for i in range(900)] + [(7, "copy", "x")] * 300
    digests = set()
    for n in (2, 200):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k long, a string, b string").repartition(n)
        got = ordered.tree_digest(df, "k", ["a", "b"], leaf=4).first()
        assert got.rows == 1200
        digests.add(got.digest)
    assert digests == {plain_tree(rows, 4)}
    assert ordered.tree_digest(df.where("k <> 7"), "k", ["a", "b"], leaf=4).first().digest not in digests
    assert ordered.tree_digest(df.limit(0), "k", ["a", "b"]).first().digest == hashlib.sha256(b"").hexdigest()


def test_illegal_moves_are_rejected(spark):
    moves = {("NEW", "a"): "ONE", ("ONE", "b"): "TWO", ("TWO", "a"): "ONE"}
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, 3]), i, rng.choice(["a", "b", "c", None])) for i in range(300)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "k long, t long, e string").repartition(9)
    got = {r.t: (r.state_before, r.accepted, r.state) for r in ordered.lifecycle(df, "k", ["t"], "e", moves, "NEW").collect()}
    state = {}
    for k, t, e in rows:
        now = state.get(k, "NEW")
        to = moves.get((now, e))
        assert got[t] == (now, to is not None, to or now)
        state[k] = to or now


def test_the_longest_host_rule_edits_in_order(spark):
    rules = [("Example.com", 2, "replace", "b+", None, "B"), ("example.com", 1, "header", "aa?", None, None), ("x.example.com", 1, "tail", "STOP", 5, None), ("com", 1, "replace", ".", None, "!"), ("net", 1, "tail", "STOP", None, None)]
    rows = [(1, "example.com", "aab STOP bb "), (2, "y.EXAMPLE.com", "aaab"), (3, "x.example.com", "12345STOPx"), (4, "x.example.com", "1234STOPx"), (5, "a.x.example.com", " STOP 123456 STOP"), (6, "notexample.com", "abc"), (7, None, " a "), (8, "org", " aab"), (9, "net", "k" * 299 + "STOP"), (10, "net", "k" * 300 + "STOPx"), (11, "example.com", None), (12, "", "q")]
    got = {r.k: (r.rule_host, r.clean) for r in site_rules.apply_rules(spark.createDataFrame(rows, "k long, h string, t string"), "h", "t", spark.createDataFrame(rules, "host string, step int, kind string, pattern string, keep int, with string")).collect()}
    assert got == {1: ("example.com", "B STOP B"), 2: ("example.com", "aB"), 3: ("x.example.com", "12345"), 4: ("x.example.com", "1234STOPx"), 5: ("x.example.com", "STOP 123456 STOP"), 6: ("com", "!!!"), 7: (None, "a"), 8: (None, "aab"), 9: ("net", "k" * 299 + "STOP"), 10: ("net", "k" * 300), 11: ("example.com", None), 12: (None, "q")}
    assert re.search("BroadcastNestedLoop|Cartesian", site_rules.apply_rules(spark.createDataFrame(rows, "k long, h string, t string"), "h", "t", spark.createDataFrame(rules, "host string, step int, kind string, pattern string, keep int, with string"))._jdf.queryExecution().toString()) is None


def test_stored_sketches_merge_within_their_bound(spark):
    rng = random.Random(2)
    rows = [(g, i % 9, rng.expovariate(1) if g == "a" else float(i)) for i in range(30_000) for g in "ab"] + [("a", 1, None), ("b", 2, float("nan"))]
    df, folder = spark.createDataFrame(rows, "g string, part int, v double"), new_folder(spark, "sketches")
    sketches.write(df.where("part < 5"), ["g"], "v", "part", folder, size=512)
    sketches.write(df.where("part >= 5"), ["g"], "v", "part", folder, size=512)
    points = {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    parts = spark.read.parquet(folder)
    assert parts.count() == 18
    exact = {(r.g, r.point): r.quantile for r in corpus.exact_quantiles(df.where("v is not null and not isnan(v)"), ["g"], "v", list(points.values())).collect()}
    for r in sketches.quantiles(parts, ["g"], points).collect():
        values = sorted(v for g, _, v in rows if g == r.g and v is not None and v == v)
        assert r.n == 30_000 and abs(r["mean"] - sum(values) / len(values)) < 1e-5
        for name, q in points.items():
            assert abs(bisect.bisect_left(values, r[name]) / len(values) - q) < 3.0 / 512
            assert abs(bisect.bisect_left(values, exact[r.g, q]) / len(values) - q) < 1e-3


def test_a_shared_folder_without_scheme_is_on_the_default_file_system(spark, tmp_path):
    from tessera.session import qualified

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert qualified(spark, str(tmp_path)) == f"file://{tmp_path}" == qualified(spark, f"file:{tmp_path}")
    conf.set("fs.defaultFS", "viewfs://cluster/")
    conf.set("fs.viewfs.mounttable.cluster.link./shared", f"file://{tmp_path}")
    try:
        assert qualified(spark, "/shared/checkpoints") == "viewfs://cluster/shared/checkpoints"
    finally:
        conf.set("fs.defaultFS", before)
