"""Quality classification by co-training on two views of a document.

The text view reads the distinct hashed words of the whole text. The metadata view never sees a
word: it reads source, language and stated number of characters, and the layout of the page in bins
(lines, their length and repetition, size, and the shares of symbols, capitals, digits and repeats).
Both are logistic models. In each round a view labels the pool of unlabelled documents; labels of
which it is confident, as measured on calibration rows that no model learns from, are given to the
other view, which learns from them beside the true labels. In the last fit a bad row counts in a view
as far as the other one finds no fault in it, so that each learns what it alone can see. Then each view's logits are calibrated,
and a last model of both gives the score, the product of the chances of no fault in either view:
the probability that a document is of good quality and not toxic. What each view gave in each round is kept in the model's history.

Fit on bounded samples of rows, chosen by a hash of the identifier; every document is scored.

Defined results: null and empty texts are read as texts of no words; labels that disagree or repeat
count as the worst of them; unlabelled documents serve the pool; with no labels of either kind each
document scores 0.5 and is kept; missing columns of metadata are left out of that view.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.chunks import chunk_codes, listed, slices
from tessera.session import ship_package

#: Rows that are fitted on at most, labelled and not.
LABELLED, POOL = 12_000, 8_000
CHI_SQUARE = 15.0
BITS, ROUNDS, CONFIDENT, PRECISION, EPOCHS, KEEP = 18, 3, 0.97, 0.97, 8, 0.5
_WORDS = 1 << BITS
_BINS = 16
#: The layout features, each in bins after the hashed metadata.
SHAPES = ("symbols", "capitals", "digits", "bare", "repeats", "word_length", "words", "line_length", "lines", "repeated_lines", "size_gap")
WIDTH = _WORDS
_META = 1 << 12
META_WIDTH = _META + len(SHAPES) * _BINS


def features(texts: pa.Array, columns: dict[str, list]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(offsets, ascending active features) of each text in the text view and in the metadata view."""
    offsets, chunks, codes = chunk_codes(texts)
    words = listed(chunks)
    ids, shape = np.zeros(len(words) + 1, np.int64), np.zeros((len(words) + 1, 5))
    for i, c in enumerate(words):
        core = c.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»…")
        ids[i] = xxhash.xxh3_64_intdigest(core.lower()) & (_WORDS - 1)
        n = len(core)
        plain = core.isalpha()
        symbols = len(c) - n + (0 if plain else sum(not x.isalnum() for x in core))
        soft = c[n:] in ("", ",", ".") if c.startswith(core) else False
        shape[i] = (0 if soft and plain else symbols, n if n > 1 and core.isupper() else 0, 0 if plain else sum(x.isdigit() for x in core), n == 0, len(c))
    sizes, n = np.diff(offsets), len(texts)
    doc = np.repeat(np.arange(n), sizes)
    totals = np.stack([np.bincount(doc, weights=shape[codes, j], minlength=n) for j in range(5)], axis=1) if len(codes) else np.zeros((n, 5))
    distinct = np.bincount(np.unique(doc * (1 << 40) + codes) >> 40, minlength=n)
    key = np.unique(doc * (1 << 40) + ids[codes])
    text = np.concatenate(([0], np.cumsum(np.bincount(key >> 40, minlength=n)))), key & ((1 << 40) - 1)
    lines, own, chars = np.ones(n), np.ones(n), np.zeros(n)
    for i, t in enumerate(texts.to_pylist()):
        if t:
            chars[i] = len(t)
            if "\n" in t:
                rows = t.split("\n")
                lines[i], own[i] = len(rows), len(set(rows))
    stated = np.array([-1 if v is None else v for v in columns.get("n_chars", [None] * n)], np.float64)
    gap = np.where(stated < 0, _BINS - 1, np.minimum(np.abs(stated - chars) / np.maximum(chars, 1) * 20, _BINS - 2))
    letters, count = np.maximum(totals[:, 4], 1), np.maximum(sizes, 1)
    values = [totals[:, 0] / letters * 40, totals[:, 1] / letters * 15, totals[:, 2] / letters * 40, totals[:, 3] / count * 30, (1 - distinct / count) * 15, totals[:, 4] / count, np.log2(sizes + 1), np.log2(count / lines + 1) * 2, np.log2(lines) * 2, (1 - own / lines) * 15, gap]
    shapes = np.stack([np.clip(np.ceil(v), 0, _BINS - 1).astype(np.int64) + j * _BINS + _META for j, v in enumerate(values)], axis=1)
    named = _metadata(columns, n)
    flat = np.concatenate([x for r, t in zip(named, shapes, strict=True) for x in (r, t)]) if n else np.zeros(0, np.int64)
    return text, (np.concatenate(([0], np.cumsum([len(r) + len(SHAPES) for r in named]))).astype(np.int64), flat)


def _metadata(columns: dict[str, list], n: int) -> list[np.ndarray]:
    """Hashed source, language and length bin, each alone and source with language."""
    rows, known = [], {}
    for i in range(n):
        parts = tuple(f"{c}={None if v[i] is None or c == 'n_chars' and v[i] < 0 else int(2 * np.log2(v[i] + 1)) if c == 'n_chars' else v[i]}" for c, v in columns.items())
        if parts not in known:
            both = "|".join(p for p in parts if not p.startswith("n_chars"))
            known[parts] = np.unique([xxhash.xxh3_64_intdigest(p) % _META for p in (*parts, both)])
        rows.append(known[parts])
    return rows


class Rows:
    """Sets of features of many documents, end to end."""

    def __init__(self, lists: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.flat = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)

    def only(self, kept: np.ndarray) -> None:
        """Forget all features but the kept."""
        hold = kept[self.flat]
        self.ends = np.concatenate(([0], np.cumsum(hold)))[self.ends]
        self.sizes = np.diff(self.ends, prepend=0)
        self.flat = self.flat[hold]

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        index = np.repeat(self.ends[at] - self.sizes[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[index], np.repeat(np.arange(len(at)), sizes)


class Logistic:
    """Logistic regression over sets of features, by AdaGrad over small batches."""

    def __init__(self, width: int):
        self.w, self.bias = np.zeros(width), 0.0

    def logits(self, rows: Rows, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at))
        for i in range(0, len(at), 1024):
            flat, doc = rows.take(at[i : i + 1024])
            out[i : i + 1024] = np.bincount(doc, weights=self.w[flat], minlength=len(at[i : i + 1024]))
        return out + self.bias

    def fit(self, rows: Rows, at: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 0, rate: float = 0.3, decay: float = 1e-5) -> Logistic:
        rng = np.random.default_rng(seed)
        width = len(self.w)
        square, bias_square = np.full(width, 1e-2), 1e-2
        for _ in range(EPOCHS):
            order = rng.permutation(len(at))
            for i in range(0, len(order), 128):
                pick = order[i : i + 128]
                flat, doc = rows.take(at[pick])
                z = np.bincount(doc, weights=self.w[flat], minlength=len(pick)) + self.bias
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) * weight[pick]
                g = np.bincount(flat, weights=error[doc], minlength=width)
                touched = np.flatnonzero(g)
                step = g[touched] + decay * self.w[touched]
                square[touched] += step * step
                self.w[touched] -= rate * step / np.sqrt(square[touched])
                bias_square += error.sum() ** 2
                self.bias -= rate * error.sum() / np.sqrt(bias_square)
        return self


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic fit of columns z by Newton steps with a little ridge: (weights, bias last)."""
    x = np.column_stack([z, np.ones(len(z))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        w = w - np.linalg.solve(h, x.T @ (p - y) + 1e-2 * w)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _joined(t: np.ndarray, m: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The chance that a document is good in either view: each view's logit, scaled anew, gives the
    chance of no fault that this view can see."""
    return _sigmoid(w[0] * t + w[1]) * _sigmoid(w[2] * m + w[3])


def _combine(t: np.ndarray, m: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The scales of _joined by maximum likelihood with a little ridge; gradient steps with momentum."""
    w, first, second = np.array([1.0, 1.0, 1.0, 1.0]), np.zeros(4), np.zeros(4)
    for step in range(1, 801):
        a, b = _sigmoid(w[0] * t + w[1]), _sigmoid(w[2] * m + w[3])
        p = np.clip(a * b, 1e-9, 1 - 1e-9)
        d = (y - p) / (1 - p)  # of the log likelihood by log p
        da, db = d * (1 - a), d * (1 - b)
        g = np.array([(da * t).mean(), da.mean(), (db * m).mean(), db.mean()]) - 1e-4 * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w + 0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


class Model:
    """history: for each round and view, the area under the curve on calibration rows and, for each
    label that the view gave, how many it gave and how many calibration rows of it were right."""

    def __init__(self, text: Logistic, meta: Logistic, text_scale, meta_scale, both, names, history=()):
        self.text, self.meta, self.text_scale, self.meta_scale, self.both, self.names, self.history = text, meta, text_scale, meta_scale, both, names, list(history)

    def scores(self, zt: np.ndarray, zm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, text view, metadata view), all probabilities."""
        t, m = np.column_stack([zt, np.ones(len(zt))]) @ self.text_scale, np.column_stack([zm, np.ones(len(zm))]) @ self.meta_scale
        return _joined(t, m, self.both), _sigmoid(t), _sigmoid(m)


def area(z: np.ndarray, y: np.ndarray) -> float:
    """The chance that a good row is ranked above a bad one, ties by half."""
    _, place, met = np.unique(z, return_inverse=True, return_counts=True)
    rank = (np.cumsum(met) - (met - 1) / 2)[place]
    good = int(y.sum())
    return float((rank[y == 1].sum() - good * (good + 1) / 2) / max(1, good * (len(y) - good)))


def telling(rows: Rows, at: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """The features that go with a class: by chi-square of presence against label, above CHI_SQUARE.
    Frequent words that say nothing and rare ones that would be learnt by heart are left out."""
    flat, doc = rows.take(at)
    n, good = len(at), y.sum()
    met = np.bincount(flat, minlength=width).astype(np.float64)
    both = np.bincount(flat, weights=y[doc], minlength=width)
    part = met * (n - met) * good * (n - good)
    return np.where(part > 0, n * (both * n - met * good) ** 2 / np.maximum(part, 1), 0) >= CHI_SQUARE


def cotrain(text: Rows, meta: Rows, y: np.ndarray, names: list[str], rounds: int = ROUNDS) -> Model | None:
    """y: 1 good, 0 bad, -1 unlabelled. None if a class has fewer than ten rows."""
    labelled = np.flatnonzero(y >= 0)
    if min((y == 0).sum(), (y == 1).sum()) < 10:
        return None
    calibration = labelled[np.arange(len(labelled)) % 4 == 0]
    train = labelled[np.arange(len(labelled)) % 4 != 0]
    pool = np.flatnonzero(y < 0)
    views = [(text, WIDTH), (meta, META_WIDTH)]
    for rows, width in views:
        rows.only(telling(rows, train, y[train], width))
    given = [np.full(len(y), -1) for _ in views]  # pseudo-labels that each view has received
    history, last = [], None

    def p_of(v: int, at: np.ndarray, fitted) -> np.ndarray:
        return _sigmoid(fitted[0][v].logits(views[v][0], at) * fitted[1][v][0] + fitted[1][v][1])

    for step in range(rounds + 1):
        models, scales, told = [], [], []
        for (rows, width), extra in zip(views, given, strict=True):
            taught = np.flatnonzero(extra >= 0)
            at, target = np.concatenate((train, taught)), np.concatenate((y[train], extra[taught]))
            share = np.clip(target.mean(), 0.05, 0.95)
            weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)) * np.concatenate((np.ones(len(train)), np.full(len(taught), 0.3)))
            if step and step == rounds:  # a fault that the other view sees need not be learnt in this one
                v = 1 - len(models)
                weight[: len(train)] *= np.where(y[train] == 0, p_of(v, train, last), 1)
            model = Logistic(width).fit(rows, at, target, weight)
            scale = _calibrate(model.logits(rows, calibration)[:, None], y[calibration])
            models.append(model)
            scales.append(scale)
        last = models, scales
        if step == rounds or not len(pool):
            break
        for v in range(2):
            on_calibration, on_pool = p_of(v, calibration, last), p_of(v, pool, last)
            label, entry = np.full(len(y), -1), {"round": step, "view": ("text", "meta")[v], "area": area(on_calibration, y[calibration])}
            for value, chosen, sure in ((1, on_pool >= CONFIDENT, on_calibration >= CONFIDENT), (0, on_pool <= 1 - CONFIDENT, on_calibration <= 1 - CONFIDENT)):
                if sure.sum() >= 20 and (y[calibration][sure] == value).mean() >= PRECISION:
                    label[pool[chosen]] = value
                    entry[("bad", "good")[value]] = (int(chosen.sum()), float((y[calibration][sure] == value).mean()))
            told.append(label)
            history.append(entry)
        given = [told[1], told[0]]
    z = [m.logits(rows, calibration) for m, (rows, _) in zip(models, views, strict=True)]
    both = _combine(*[z[v] * scales[v][0] + scales[v][1] for v in (0, 1)], y[calibration])
    return Model(models[0], models[1], scales[0], scales[1], both, names, history)


def _views(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, list[str]]:
    names = [c for c in ("source", "lang", "n_chars") if c in docs.columns]
    return docs.select(F.col(key).alias("k"), F.col(text).alias("text"), *[F.col(c).cast("long" if c == "n_chars" else "string").alias(c) for c in names]), names


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", labelled: int = LABELLED, pool: int = POOL) -> Model | None:
    """Co-train on at most about `labelled` rows with a label and `pool` rows without one."""
    ship_package(docs.sparkSession)
    known = labels.groupBy(F.col(key).alias("lk")).agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    known = known.where("q is not null").select("lk", F.when((F.col("q") == 1) & (F.col("t") == 0), 1).otherwise(0).alias("y"))
    total, rated = docs.count(), known.count()
    views, names = _views(docs, key, text)
    place = F.pmod(F.xxhash64("k", F.lit(29)), F.lit(1_000_000))
    few = views.where((place < int(1_000_000 * min(1, labelled / max(rated, 1)))) | (place >= 1_000_000 - int(1_000_000 * min(1, pool / max(total - rated, 1)))))
    few = few.join(known, few["k"] == known["lk"], "left").withColumn("place", place)
    few = few.where((F.col("y").isNotNull() & (F.col("place") < int(1_000_000 * min(1, labelled / max(rated, 1))))) | (F.col("y").isNull() & (F.col("place") >= 1_000_000 - int(1_000_000 * min(1, pool / max(total - rated, 1))))))
    few = few.select("k", "text", *names, F.coalesce("y", F.lit(-1)).alias("y"), "place")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                columns = {c: part.column(c).to_pylist() for c in names}
                (to, tf), (mo, mf) = features(part.column("text"), columns)
                yield pa.RecordBatch.from_arrays([part.column("place"), part.column("y"), pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(tf, pa.int32())), pa.ListArray.from_arrays(pa.array(mo, pa.int32()), pa.array(mf, pa.int32()))], names=["place", "y", "t", "m"])

    table = few.mapInArrow(run, "place long, y int, t array<int>, m array<int>").toArrow()  # bounded by labelled + pool rows
    order = np.lexsort((table.column("y").to_numpy(), table.column("place").to_numpy()))
    t, m = ([table.column(c)[int(i)].values.to_numpy() for i in order] for c in ("t", "m"))
    return cotrain(Rows(t), Rows(m), table.column("y").to_numpy()[order], names)


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """(key, score, text_score, meta_score, keep) of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    views, names = _views(docs, key, text)
    shared = spark.sparkContext.broadcast(model)  # a weight for each of WIDTH features

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                n = part.num_rows
                if model is None:
                    out = [np.full(n, 0.5)] * 3
                else:
                    (to, tf), (mo, mf) = features(part.column("text"), {c: part.column(c).to_pylist() for c in names})
                    z = [np.bincount(np.repeat(np.arange(n), np.diff(o)), weights=m.w[f], minlength=n) + m.bias for o, f, m in ((to, tf, model.text), (mo, mf, model.meta))]
                    out = model.scores(*z)
                yield pa.RecordBatch.from_arrays([part.column("k"), *[pa.array(x) for x in out], pa.array(out[0] >= keep)], names=["k", "score", "text_score", "meta_score", "keep"])

    return views.mapInArrow(run, f"k {views.schema['k'].dataType.simpleString()}, score double, text_score double, meta_score double, keep boolean").withColumnRenamed("k", key)


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """The rows of docs that the classifier keeps."""
    spark = docs.sparkSession
    model = fit(docs, labels, key, text)
    if model is None:
        return docs
    shared = spark.sparkContext.broadcast(model)
    kinds = {"n_chars": pa.int64()}

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, text):
                n = part.num_rows
                columns = {c: part.column(c).cast(kinds.get(c, pa.string())).to_pylist() for c in model.names}
                (to, tf), (mo, mf) = features(part.column(text), columns)
                z = [np.bincount(np.repeat(np.arange(n), np.diff(o)), weights=m.w[f], minlength=n) + m.bias for o, f, m in ((to, tf, model.text), (mo, mf, model.meta))]
                yield part.filter(pa.array(model.scores(*z)[0] >= keep))

    return docs.mapInArrow(run, docs.schema)
