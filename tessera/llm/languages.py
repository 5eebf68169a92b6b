"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed character trigrams of lower-cased letters and marks, with
one space between words, learnt from labelled documents and smoothed. A document is a mixture: its
trigrams are drawn from its languages in unknown proportions, which expectation-maximisation finds.
The set of languages is chosen by penalised likelihood: the likeliest 1, 2, 3 ... languages are
fitted, and each further one must raise the log likelihood by more than `penalty` * log(trigrams).
lang_pred is the language of the largest proportion in the chosen set, score that proportion.

Defined results: a text that is null or without letters (category L, of any plane; marks are none) gives `und` with score 0 and no languages;
documents of any length are read whole; ties go to the language first in order; repeated rows are
predicted each. If nothing is labelled every document is `und`.
"""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.chunks import slices
from tessera.session import ship_package

#: Labelled documents that a model is fitted on at most; chosen by hash of the identifier.
FIT_DOCUMENTS = 20_000
FEATURES, ROUNDS, PENALTY, SMOOTH = 1 << 16, 8, 3.0, 0.5
#: Cells of a model at most, 64 MB: with more than 256 languages trigrams are hashed more coarsely.
CELLS = 1 << 24
UND = "und"
#: The proportion of its main language from which a document counts as being in it.
LEAST = 0.5
#: Bytes of text at once: arrays of some fifty bytes a letter stand beside it.
SLICE = 1_500_000


def _letters_of(batch_text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, lower-cased, with everything but letters and marks made a space; which are letters."""
    points = np.frombuffer(batch_text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[points], _LETTER[points]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of all code points; those above plane 3, but for some marks and tags of plane 14, are
    unassigned or private."""
    out, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for part in (range(0x40000), range(0xE0000, 0xE1000)):
        for i in part:
            c = chr(i)
            kind = unicodedata.category(c)[0]
            if kind in "LM":
                low = c.lower()
                out[i] = ord(low) if len(low) == 1 else i
                letter[i] = kind == "L"
    return out, letter


_TABLE, _LETTER = _tables()


def trigrams(texts: pa.Array, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count) of the distinct trigrams of each text, and letters in each text."""
    lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    text = pc.binary_join(pa.scalar(pc.fill_null(texts, "").to_pylist(), pa.list_(pa.string())), "").as_py() if len(texts) else ""
    c, counted = _letters_of(text)
    doc = np.repeat(np.arange(len(texts)), lengths)
    letter = c != 32
    letters = np.bincount(doc[counted], minlength=len(texts))
    keep = letter.copy()
    if len(keep):
        keep[1:] |= letter[:-1] & (doc[1:] == doc[:-1])  # one space after each word
    c, doc = c[keep], doc[keep]
    before = np.concatenate(([32], c[:-1])).astype(np.uint64)
    after = np.concatenate((c[1:], [32])).astype(np.uint64)
    if len(c):
        new = np.concatenate(([True], doc[1:] != doc[:-1]))
        before[new] = 32
        after[np.concatenate((new[1:], [True]))] = 32
    h = (before * np.uint64(0x9E3779B1) + c.astype(np.uint64) * np.uint64(0x85EBCA77) + after * np.uint64(0xC2B2AE3D)) * np.uint64(0x27D4EB2F165667C5)
    key = (doc.astype(np.uint64) * np.uint64(features) + (h >> np.uint64(40)) % np.uint64(features)).astype(np.int64)
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate((first, [len(key)])))
    key = key[first]
    return key // features, key % features, count, letters


def _mix(p: np.ndarray, count: np.ndarray, starts: np.ndarray, sizes: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log likelihood) of each document over its allowed languages."""
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    total = np.add.reduceat(count, starts)
    for _ in range(rounds):
        m = np.einsum("fl,fl->f", p, np.repeat(pi, sizes, axis=0))
        pi = pi * np.add.reduceat(p * (count / m)[:, None], starts, axis=0) / total[:, None]
    m = np.einsum("fl,fl->f", p, np.repeat(pi, sizes, axis=0))
    return pi, np.add.reduceat(count * np.log(m), starts)


def infer(model: np.ndarray, doc: np.ndarray, feature: np.ndarray, count: np.ndarray, n: int, penalty: float = PENALTY) -> np.ndarray:
    """Proportions of each of n documents over the languages; a row of zeros has no trigram.

    The likeliest languages of the full mixture are added one by one; each must pass the penalty, and
    once no document gains by a further language none is fitted.
    """
    languages = model.shape[1]
    out = np.zeros((n, languages))
    if not len(doc):
        return out
    starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(doc)])))
    p = model[feature].astype(np.float64)
    c = count.astype(np.float64)
    full, _ = _mix(p, c, starts, sizes, np.ones((len(starts), languages)), ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    total = np.add.reduceat(c, starts)
    best = np.zeros_like(full)
    rows = np.arange(len(starts))
    single = np.add.reduceat(np.log(p) * c[:, None], starts, axis=0)
    top = np.argmax(single, axis=1)
    best[rows, top] = 1
    value = single[rows, top] - penalty * np.log(total + 1)
    for k in range(2, languages + 1):
        allowed = np.zeros_like(full)
        np.put_along_axis(allowed, order[:, :k], 1, axis=1)
        pi, likelihood = _mix(p, c, starts, sizes, allowed, ROUNDS)
        now = likelihood - k * penalty * np.log(total + 1)
        better = now > value
        best[better], value = pi[better], np.maximum(value, now)
        if not better.any():
            break
    out[doc[starts]] = best
    return out


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", most: int = FIT_DOCUMENTS) -> tuple[list[str], np.ndarray]:
    """(languages in order, probabilities of the features) from at most about `most` labelled rows.

    Rows are chosen by a hash of their identifier against a share that one count of the labels sets.
    Counts are summed by language and feature before they reach the driver: CELLS of them at most.
    """
    ship_package(docs.sparkSession)
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    total = labelled.count()
    if total > most:
        labelled = labelled.where(F.pmod(F.xxhash64(F.col("k"), F.lit(17)), F.lit(1_000_000)) < int(1_000_000 * most / total))
    features, known = FEATURES, labelled.agg(F.count_distinct("lang")).first()[0]
    while features * known > CELLS and features > 1:
        features //= 2

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                codes = part.column("lang").dictionary_encode()
                doc, feature, count, _ = trigrams(part.column("text"), features)
                place = codes.indices.to_numpy()[doc].astype(np.int64) * features + feature
                at, row = np.unique(place, return_inverse=True)
                n = np.bincount(row, weights=count, minlength=len(at)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([codes.dictionary.take(pa.array(at // features)), pa.array(at % features, pa.int32()), pa.array(n)], names=["lang", "feature", "n"])

    counts = labelled.mapInArrow(run, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    codes = counts.column("lang").combine_chunks().dictionary_encode()
    found = codes.dictionary.to_pylist()
    names = sorted(found)
    table = np.full((features, len(names)), SMOOTH)
    if names:
        place = np.array([names.index(x) for x in found])
        table[counts.column("feature").to_numpy(), place[codes.indices.to_numpy()]] += counts.column("n").to_numpy()
    return names, (table / table.sum(axis=0)).astype(np.float32)


def identify(docs: DataFrame, names: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text", penalty: float = PENALTY) -> DataFrame:
    """(key, lang_pred, score, languages, proportions) of every row, by its text alone."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((names, model))  # 64 MB at most
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))

    def run(batches):
        names, model = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                doc, feature, count, letters = trigrams(part.column("text"), len(model))
                pi = infer(model, doc, feature, count, part.num_rows, penalty) if names else np.zeros((part.num_rows, 1))
                pi[letters == 0] = 0
                top = pi.argmax(axis=1)
                score = pi[np.arange(len(pi)), top]
                chosen = [np.flatnonzero(r > 0) for r in pi]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("k"),
                        pa.array([names[t] if s > 0 else UND for t, s in zip(top, score, strict=True)], pa.string()),
                        pa.array(np.minimum(score, 1.0), pa.float64()),
                        pa.array([[names[i] for i in c] for c in chosen], pa.list_(pa.string())),
                        pa.array([r[c].tolist() for r, c in zip(pi, chosen, strict=True)], pa.list_(pa.float64())),
                    ],
                    names=["k", "lang_pred", "score", "languages", "proportions"],
                )

    kind = source.schema["k"].dataType.simpleString()
    return source.mapInArrow(run, f"k {kind}, lang_pred string, score double, languages array<string>, proportions array<double>").withColumnRenamed("k", key)


def held_out(key: str = "doc_id"):
    """Whether a document is held out: crc32 of its identifier as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fitting(model: np.ndarray, pi: np.ndarray, doc: np.ndarray, feature: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Mean log likelihood of each document's trigrams under its mixture, above that of trigrams
    drawn evenly; negative for a text in a language that was not learnt."""
    p = np.einsum("fl,fl->f", model[feature], pi[doc])
    gain = np.bincount(doc, weights=count * (np.log(np.maximum(p, 1e-30)) + math.log(len(model))), minlength=len(pi))
    return gain / np.maximum(np.bincount(doc, weights=count, minlength=len(pi)), 1)


def accepted(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of docs that are in a language: the largest proportion of the chosen set is at least
    `least`, and the text is likelier under its mixture than as an even draw of trigrams.

    Texts that are null or without letters go, as do mixtures without a main language and texts in
    languages that were not learnt. With nothing labelled every text with a letter stays.
    """
    names, model = fit(docs.where(~held_out(key)), key, text)
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((names, model))

    def run(batches):
        names, model = shared.value
        for batch in batches:
            for part in slices(batch, text, SLICE):
                doc, feature, count, letters = trigrams(part.column(text), len(model))
                keep = letters > 0
                if names:
                    pi = infer(model, doc, feature, count, part.num_rows)
                    keep &= (pi.max(axis=1) >= least) & (fitting(model, pi, doc, feature, count) > 0)
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
