"""Language model, language identification, quality and block labelling."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import blocks, cotraining, interpolation, languages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def held(key, remainder):
    return zlib.crc32(str(key).encode()) % 5 == remainder


def test_packing_round_trips():
    for a in (np.zeros(0, np.uint64), np.array([0, 5, 5, 2**63, 2**64 - 1], np.uint64)):
        assert (interpolation.unpack_keys(interpolation.pack_keys(a)) == a).all()
    for top in (3, 300, 70_000, 2**40):
        n = np.array([0, 1, top])
        assert interpolation.unpack(interpolation.pack_counts(n)).astype(np.int64).tolist() == n.tolist()


def slow_scores(rows, is_held):
    """The same model by plain dictionaries and one token at a time."""
    train = [tokens(t) for k, t in rows if not is_held(k)]
    c1 = collections.Counter(w for t in train for w in t)
    c2 = collections.Counter((v, w) for t in train for v, w in zip(["<s>", *t], t))
    cv = lambda v: len(train) if v == "<s>" else c1[v]
    n, types = sum(c1.values()), len(c1)
    cells = collections.defaultdict(lambda: np.zeros(3))
    for t in train:
        for v, w in zip(["<s>", *t], t):
            left = cv(v) - 1
            p2 = (c2[v, w] - 1) / left if left > 0 else 0.0
            b = 1 + int(math.log2(left)) if left > 0 else 0
            bin2 = int(min(127, max(1, 127 + math.floor(2 * math.log2(p2))))) if p2 > 0 else 0
            bin1 = 1 + int(math.log2(c1[w] - 1)) if c1[w] > 1 else 0
            cells[(b, bin2, bin1)] += [1, p2, c1[w] - 1]
    grid = np.array([[k[0], *v] for k, v in sorted(cells.items())]) if cells else np.zeros((0, 4))
    weights = interpolation.em(grid, n, types)
    out = []
    for _, text in rows:
        total = 0.0
        for v, w in zip(["<s>", *tokens(text)], tokens(text)):
            k = cv(v)
            l2, l1, l0 = weights[1 + int(math.log2(k)) if k else 0]
            total += math.log10(l2 * (c2[v, w] / k if k else 0) + l1 * c1[w] / n + l0 / (types + 1))
        out.append(total)
    return out, c1, n, types


def test_scores_equal_the_plain_model(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).collect()]
    rows += [(9001, None), (9002, ""), (9003, "A b"), (9003, "A b"), (9004, "word " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as g", "'k' as k", "true as held")
    got = interpolation.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, groups=5).collect()
    want, c1, n, types = slow_scores(rows, lambda k: held(k, 1))
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(got) == len(rows)
    for (k, text), w in zip(rows, want):
        r, t = by[k][0], tokens(text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(k, 1), len(t), sum(c1[x] > 0 for x in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c1[x] + 0.5) / (n + 0.5 * (types + 1))) for x in t), rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(w, rel=1e-6, abs=1e-6)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def exact_scores(rows, is_held):
    """The model with its own EM over every deleted token, not over cells of sums."""
    train = [tokens(t) for k, t in rows if not is_held(k)]
    c1 = collections.Counter(w for t in train for w in t)
    c2 = collections.Counter((v, w) for t in train for v, w in zip(["<s>", *t], t))
    cv = lambda v: len(train) if v == "<s>" else c1[v]
    n, types = sum(c1.values()), len(c1)
    group = lambda k: 1 + int(math.log2(k)) if k else 0
    seen = collections.defaultdict(list)
    for t in train:
        for v, w in zip(["<s>", *t], t):
            left = cv(v) - 1
            seen[group(left)].append(((c2[v, w] - 1) / left if left else 0.0, (c1[w] - 1) / max(1, n - 1), 1 / (types + 1)))
    p = {b: np.array(x) for b, x in seen.items()}
    weights = {b: np.full(3, 1 / 3) for b in p}
    for _ in range(interpolation.EM_ROUNDS):
        got = {}
        for b, x in p.items():
            share = x * weights[b]
            got[b] = (share / share.sum(axis=1, keepdims=True)).sum(axis=0)
        overall = sum(got.values()) / sum(g.sum() for g in got.values())
        weights = {b: (g + overall) / (g + overall).sum() for b, g in got.items()}
    weights.setdefault(0, overall.copy())
    weights[0] = np.array([0, *(weights[0][1:] / weights[0][1:].sum())])
    out = []
    for _, text in rows:
        t = tokens(text)
        out.append(sum(math.log10(sum(weights.get(group(cv(v)), overall) * (c2[v, w] / cv(v) if cv(v) else 0, c1[w] / n, 1 / (types + 1)))) for v, w in zip(["<s>", *t], t)))
    return np.array(out)


def test_the_grid_loses_little_against_exact_em(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in interpolation.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, groups=5).collect()}
    want = exact_scores(rows, lambda k: held(k, 1))
    mine = np.array([got[k] for k, _ in rows])
    out = np.array([held(k, 1) for k, _ in rows])
    assert abs(mine[out].sum() / want[out].sum() - 1) < 2e-3 and np.abs(mine / want - 1).max() < 0.02


def test_any_kind_of_identifier(spark):
    df = spark.createDataFrame([("2020-01-01", "a b"), (None, "c")], "d string, text string").selectExpr("cast(d as date) as doc_id", "text")
    assert interpolation.score(df, F.lit(False)).count() == 2


def test_shares_cover_the_hash_range():
    keys = np.sort(np.random.default_rng(2).integers(0, 1 << 64, 5000, dtype=np.uint64))
    for buckets in (1, 3, 70, 10**6):
        got = interpolation.shares(keys, buckets)
        assert [k for k, _, _ in got] == sorted({k for k, _, _ in got}) and got[-1][0] < buckets
        assert got[0][1] == 0 and got[-1][2] == len(keys) and all(x[2] == y[1] for x, y in zip(got, got[1:]))


def test_scores_without_training_or_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert all(r.score == 0 and r.base_score == 0 for r in interpolation.score(df, F.lit(True)).collect())
    assert interpolation.score(df.limit(0), F.lit(True)).count() == 0


def test_the_model_is_a_distribution():
    weights = interpolation.em(np.array([[0, 5, 0, 3], [3, 50, 20, 400.0]]), 1000, 50)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0


def test_languages_held_out_accuracy_and_edges(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, model = languages.fit(docs.where(~languages.held_out()))
    assert np.allclose(model.sum(axis=0), 1, atol=1e-3)
    got = languages.identify(docs.withColumn("k", F.lit(1)), names, model).join(docs.select("doc_id", "lang"), "doc_id").where(languages.held_out()).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    en, fr = (" ".join(r.text for r in docs.where(f"lang = '{x}'").orderBy("doc_id").limit(4).collect()) for x in ("en", "fr"))
    odd = [(1, None), (2, ""), (3, "12 -- 7!"), (4, en + " " + fr), (5, en * 20), (5, en * 20), (6, "漢字")]
    rows = {r.doc_id: r for r in languages.identify(spark.createDataFrame(odd, "doc_id long, text string"), names, model).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (1, 2, 3))
    assert {"en", "fr"} <= set(rows[4].languages) and rows[4].score < 0.9
    assert rows[5].languages == ["en"] and rows[5].score == 1 and 0 <= rows[6].score <= 1
    assert languages.identify(docs.limit(0), names, model).count() == 0
    none, empty = languages.fit(docs.limit(0))
    assert none == [] and all(r.lang_pred == "und" for r in languages.identify(docs.limit(3), none, empty).collect())


def test_mixture_equals_plain_em():
    rng = np.random.default_rng(9)
    model = rng.dirichlet(np.ones(50), 3).T
    feature = np.arange(50)
    counts = rng.multinomial(3000, model @ [0.7, 0.3, 0.0])
    pi = np.ones(3) / 3
    for _ in range(languages.ROUNDS):
        r = model * pi
        r /= r.sum(axis=1, keepdims=True)
        pi = (r * counts[:, None]).sum(axis=0) / counts.sum()
    got, _ = languages._mix(model, counts.astype(float), np.array([0]), np.array([50]), np.ones((1, 3)), languages.ROUNDS)
    assert np.allclose(got[0], pi)
    chosen = languages.infer(model, np.zeros(50, np.int64), feature, counts, 1)[0]
    assert (chosen > 0).tolist() == [True, True, False] and abs(chosen[0] - 0.7) < 0.1


def test_quality_of_labelled_rows(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    fit_on, test_on = docs.where("doc_id % 3 > 0"), docs.where("doc_id % 3 = 0")
    model = cotraining.fit(fit_on, labels)
    rows = cotraining.score(test_on, model).join(labels, "doc_id").collect()
    good = [r.keep for r in rows if r.quality == 1 and r.toxic == 0]
    junk = [r.keep for r in rows if r.quality == 0]
    toxic = [r.keep for r in rows if r.quality == 1 and r.toxic == 1]
    assert np.mean(good) > 0.96 and np.mean(junk) < 0.05 and np.mean(toxic) < 0.3
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "s", "en", 0), (2, "", None, None, None), (3, "a b " * 9000, "s", "en", 5), (3, "x", "s", "en", -1)], "doc_id long, text string, source string, lang string, n_chars long").selectExpr("*", "1 as k", "2 as y", "3 as place")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert cotraining.fit(docs, none) is None
    assert [r.score for r in cotraining.score(docs, None).collect()] == [0.5] * 4
    assert cotraining.accepted(docs, none).count() == 4
    many = spark.range(200).selectExpr("id as doc_id", "if(id % 2 = 0, 'fine words here', 'JUNK### JUNK###') as text", "'s' as source", "'en' as lang", "10L as n_chars", "0 as k", "1 as y")
    labels = many.selectExpr("doc_id", "int(doc_id % 2 = 0) as quality", "cast(null as int) as toxic").where("doc_id < 120")
    labels = labels.unionByName(labels.limit(3)).unionByName(spark.createDataFrame([(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int"))
    kept = cotraining.accepted(many, labels)
    assert kept.columns == many.columns and {r.doc_id for r in kept.collect()} == set(range(0, 200, 2))
    model = cotraining.fit(many.select("doc_id", "text"), labels)
    assert cotraining.score(docs, model).count() == 4 and cotraining.score(docs.limit(0), model).count() == 0


def article(page):
    import html as entities

    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    lines = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", s)).split()) for s in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(x for x in lines if x)


def test_pages_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = blocks.extract(pages.withColumn("k", F.lit(1)).withColumn("x0", F.lit(2))).join(pages.select("page_id", "html"), "page_id").collect()
    right = np.mean([r.text == article(r.html) for r in got])
    assert right > 0.97 and all(r.n_chars == len(r.text) for r in got)


def test_leaf_blocks_of_odd_markup():
    text = lambda h: [b.text for b in blocks.leaf_blocks(h)]
    assert text(None) == text("") == text("<p></p><!-- x") == []
    assert text("a &amp; b&nbsp;c<br>d<p>e<b>f</p>g<script>no</p></script>h") == ["a & b c d", "ef", "gh"]
    assert text("<p>1 < 2 and <x") == ["1 < 2 and"] and text("</div></p>loose") == ["loose"]
    assert text("<ul><li>a<li>b</ul><textarea>t</textarea>") == ["a", "b"]
    assert len(text("<div>" * 3000 + "deep" + "</div>" * 3000)) == 1
    linked = blocks.leaf_blocks('<p><a href="x">all</a></p>')[0]
    assert linked.linked == 1.0


def test_gradients_are_right():
    rng = np.random.default_rng(10)
    net = blocks.Labeller(rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, sizes, y = rng.random((7, blocks.WIDTH)), np.array([3, 4]), np.array([0, 1, 1, 0, 1, 0, 1.0])

    def loss():
        z = net.logits(x, sizes)[0]
        return np.mean(np.logaddexp(0, z) - y * z)

    g = net.gradients(x, sizes, y)
    for name in ("Uf", "Wb", "cf", "o"):
        flat = net.p[name].reshape(-1)
        for i in rng.integers(0, len(flat), 5):
            before = flat[i]
            flat[i] = before + 1e-3
            up = loss()
            flat[i] = before - 1e-3
            down = loss()
            flat[i] = before
            assert (up - down) / 2e-3 == pytest.approx(g[name].reshape(-1)[i], abs=2e-4)


def test_labels_of_generated_pages(spark):
    net, rng = blocks.trained_in_task(spark), np.random.default_rng(77)
    right = total = 0
    for _ in range(120):
        page, truth = blocks._generated(rng)
        good = {" ".join(t.split()): g for t, g in truth}
        found = blocks.leaf_blocks(page)
        y = [good.get(b.text, good.get(b.text.removeprefix("© "), False)) for b in found]
        right += (net.label([found])[0] == np.array(y)).sum()
        total += len(y)
    assert right / total > 0.97


def test_extract_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<nav>x</nav>"), (None, "u", "<article><p>One two three, four five.</p></article>"), (3, "u", "<nav>x</nav>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = blocks.extract(df).collect()
    assert len(got) == 5 and all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (1, 2))
    assert blocks.extract(df.limit(0)).count() == 0


def test_both_views_exchange_labels(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    model = cotraining.fit(docs, labels)
    for view in ("text", "meta"):
        given = [h for h in model.history if h["view"] == view]
        assert len(given) == cotraining.ROUNDS and all(h["area"] > 0.75 for h in given)
        for h in given:
            told = [h[x] for x in ("bad", "good") if x in h]
            assert sum(n for n, _ in told) > 50 and all(right >= cotraining.PRECISION for _, right in told)
    assert (model.text.w != 0).sum() > 20 and (model.meta.w != 0).sum() > 10


def slow_cotraining(text, meta, y):
    """The rounds with dense matrices and one row at a time, without the class's batching of rows."""

    def fit(x, at, target, weight):
        rng, w, bias = np.random.default_rng(0), np.zeros(x.shape[1]), 0.0
        square, bias_square = np.full(x.shape[1], 1e-2), 1e-2
        for _ in range(cotraining.EPOCHS):
            order = rng.permutation(len(at))
            for i in range(0, len(order), 128):
                g, total, touched = np.zeros(len(w)), 0.0, np.zeros(len(w), bool)
                for j in order[i : i + 128]:
                    z = sum(w[f] for f in np.flatnonzero(x[at[j]])) + bias
                    error = (1 / (1 + math.exp(-max(-30, min(30, z)))) - target[j]) * weight[j]
                    g += error * x[at[j]]
                    total += error
                touched = g != 0
                step = np.where(touched, g + 1e-5 * w, 0)
                square += step**2
                w = w - 0.3 * step / np.sqrt(square)
                bias_square += total**2
                bias -= 0.3 * total / math.sqrt(bias_square)
        return lambda rows: np.array([sum(w[f] for f in np.flatnonzero(x[r])) + bias for r in rows])

    labelled = [i for i in range(len(y)) if y[i] >= 0]
    calibration, train = [i for k, i in enumerate(labelled) if k % 4 == 0], [i for k, i in enumerate(labelled) if k % 4]
    pool = [i for i in range(len(y)) if y[i] < 0]
    xs = []
    for x in (text, meta):
        x, n, good = x.copy(), len(train), sum(y[i] for i in train)
        for f in range(x.shape[1]):
            met, both = sum(x[i, f] for i in train), sum(x[i, f] * y[i] for i in train)
            part = met * (n - met) * good * (n - good)
            if not part or n * (both * n - met * good) ** 2 / part < cotraining.CHI_SQUARE:
                x[:, f] = 0
        xs.append(x)
    given = [{}, {}]
    for step in range(cotraining.ROUNDS + 1):
        models, scales = [], []
        for x, extra in zip(xs, given):
            at = np.array(train + sorted(extra))
            target = np.array([*(y[i] for i in train), *(extra[i] for i in sorted(extra))])
            share = min(0.95, max(0.05, target.mean()))
            weight = [(0.5 / share if t else 0.5 / (1 - share)) * (1 if k < len(train) else 0.3) for k, t in enumerate(target)]
            if step == cotraining.ROUNDS:
                v = 1 - len(models)
                seen = 1 / (1 + np.exp(-(last[0][v](train) * last[1][v][0] + last[1][v][1])))
                weight[: len(train)] = [w * (p if y[i] == 0 else 1) for w, p, i in zip(weight, seen, train)]
            models.append(fit(x, at, target, weight))
            scales.append(cotraining._calibrate(models[-1](calibration)[:, None], y[calibration]))
        last = models, scales
        if step == cotraining.ROUNDS:
            break
        told = []
        for m, s in zip(models, scales):
            p = lambda rows: 1 / (1 + np.exp(-(m(rows) * s[0] + s[1])))  # noqa: B023, E731
            sure, label = p(calibration), {}
            for value, hit in ((1, lambda q: q >= cotraining.CONFIDENT), (0, lambda q: q <= 1 - cotraining.CONFIDENT)):
                right = [y[i] == value for i, q in zip(calibration, sure) if hit(q)]
                if len(right) >= 20 and np.mean(right) >= cotraining.PRECISION:
                    label |= {i: value for i, q in zip(pool, p(pool)) if hit(q)}
            told.append(label)
        given = told[::-1]
    return [m(range(len(y))) * s[0] + s[1] for m, s in zip(models, scales)], given


def test_cotraining_equals_the_plain_rounds():
    rng = np.random.default_rng(12)
    n = 400
    truth = rng.integers(0, 2, n)
    text = (rng.random((n, 30)) < np.where(truth[:, None] == 1, 0.85, 0.1) * (np.arange(30) < 8) + 0.1 * (np.arange(30) >= 8)).astype(float)
    meta = (rng.random((n, 12)) < np.where(truth[:, None] == 1, 0.9, 0.08) * (np.arange(12) < 6) + 0.3 * (np.arange(12) >= 6)).astype(float)
    y = np.where(np.arange(n) < 320, truth, -1)
    lists = lambda x: cotraining.Rows([np.flatnonzero(r) for r in x])
    rows = [lists(text), lists(meta)]
    model = cotraining.cotrain(*rows, y, [])
    (zt, zm), given = slow_cotraining(text, meta, y)
    assert given[0] and given[1]
    every = np.arange(n)
    _, t, m = model.scores(model.text.logits(rows[0], every), model.meta.logits(rows[1], every))
    assert np.allclose(t, 1 / (1 + np.exp(-zt)), atol=1e-6) and np.allclose(m, 1 / (1 + np.exp(-zm)), atol=1e-6)
    told = {(h["view"], x): h[x][0] for h in model.history[-2:] for x in ("bad", "good") if x in h}
    assert sum(c for (v, _), c in told.items() if v == "meta") == len(given[0]) and sum(c for (v, _), c in told.items() if v == "text") == len(given[1])


def test_languages_equal_plain_counts_and_em():
    """Fit, trigrams, mixture and choice of 50 documents by dictionaries."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.001/documents.parquet").slice(0, 120)
    texts = [*table["text"].to_pylist()[:47], None, "7 - 7", "mot eau word"]
    langs = [*table["lang"].to_pylist()[:47], None, "en", "fr"]

    def grams(t):
        words = re.findall(r"[^\W\d_]+", (t or "").lower())
        s = " " + "".join(w + " " for w in words)
        return collections.Counter(s[i - 1 : i + 2] for i in range(1, len(s) - 1) if s[i] != " ")

    doc, feature, count, letters = languages.trigrams(pa.array(texts))
    plain = [sum(v for g, v in grams(t).items()) for t in texts]
    assert [int(x) for x in letters] == plain
    names = sorted({x for x in langs if x})
    model = np.full((languages.FEATURES, len(names)), languages.SMOOTH)
    for d, f, c in zip(doc, feature, count):
        if langs[d]:
            model[f, names.index(langs[d])] += c
    model = (model / model.sum(axis=0)).astype(np.float32)
    got = languages.infer(model, doc, feature, count, len(texts))
    for i in range(len(texts)):
        mine = [(f, c) for d, f, c in zip(doc, feature, count) if d == i]
        if not mine:
            assert not got[i].any()
            continue
        n = sum(c for _, c in mine)

        def em(allowed):
            pi = {l: 1 / len(allowed) for l in allowed}
            for _ in range(languages.ROUNDS):
                new = dict.fromkeys(allowed, 0.0)
                for f, c in mine:
                    m = sum(float(model[f, l]) * pi[l] for l in allowed)
                    for l in allowed:
                        new[l] += c * float(model[f, l]) * pi[l] / m / n
                pi = new
            return pi, sum(c * math.log(sum(float(model[f, l]) * pi[l] for l in allowed)) for f, c in mine)

        every = list(range(len(names)))
        full = em(every)[0]
        order = sorted(every, key=lambda l: -full[l])
        cost = languages.PENALTY * math.log(n + 1)
        alone = [sum(c * math.log(float(model[f, l])) for f, c in mine) for l in every]
        best, value = {int(np.argmax(alone)): 1.0}, max(alone) - cost
        for k in range(2, len(names) + 1):
            pi, likelihood = em(order[:k])
            if likelihood - k * cost > value:
                best, value = pi, likelihood - k * cost
        assert np.allclose(got[i], [best.get(l, 0.0) for l in every], atol=1e-6), i


def test_stage_rejects_texts_in_no_learnt_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(10**6, "漢字仮名交文章資料処理言語判定試験問題" * 9, None, None, None), (10**6 + 1, "123 456", None, None, None), (10**6 + 2, None, None, None, None)], docs.schema)
    kept = {r.doc_id for r in languages.accepted(docs.unionByName(odd)).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.where(r"text rlike '\\p{L}'").select("doc_id").collect()}


def test_a_long_page_is_labelled_as_in_one_piece(spark):
    net, rng = blocks.trained_in_task(spark), np.random.default_rng(5)
    page = [b for _ in range(30) for b in blocks.leaf_blocks(blocks._generated(rng)[0])]
    assert len(page) > 300
    whole = net.logits(blocks.features([page]), np.array([len(page)]))[0]
    assert np.allclose(net.long_logits(page, 64), whole, atol=1e-4)
    assert (net.label([page], blocks=100)[0] == (whole > 0)).all()
    many = "<article>" + "<p>one cell</p>" * 60_000 + "</article>"
    assert blocks.extract(spark.createDataFrame([(1, "u", many)], "page_id long, url string, html string")).first().n_blocks == 60_000


def bare_accuracy(net):
    """On layouts never seen in training: no class or id, and no tag that names a part."""
    rng, right, total = np.random.default_rng(123), 0, 0
    for _ in range(100):
        page, truth = blocks._generated(rng)
        page = re.sub(r"<(/?)(nav|aside|footer|header|main|article|section)\b", r"<\1div", re.sub(r'\s(class|id)="[^"]*"', "", page))
        good = {" ".join(t.split()): g for t, g in truth}
        found = blocks.leaf_blocks(page)
        y = [good.get(b.text, good.get(b.text.removeprefix("© "), False)) for b in found]
        right += (net.label([found])[0] == np.array(y)).sum()
        total += len(y)
    return right / total


def test_words_context_and_paths_all_count(spark):
    import copy

    net = blocks.trained_in_task(spark)
    whole = bare_accuracy(net)
    for name, rows in (("U", slice(None)), ("W", slice(blocks.PATH, blocks.PATH + blocks.WORDS)), ("W", slice(0, blocks.PATH))):
        less = copy.deepcopy(net)
        for d in "fb":
            less.p[name + d][rows] = 0
        assert bare_accuracy(less) < whole - 0.01
    assert whole > 0.92
