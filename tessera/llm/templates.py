"""Benchmark decontamination by template canonicalisation.

Both sides are cut into tokens at white space, without the punctuation around them. Numbers, names
and units become typed placeholders; all other tokens are lower-cased. A name is a capitalised
token, not all in capitals, that does not begin a sentence; a unit is a known unit after a number, or a number written
together with one, which gives two tokens. Windows of five template tokens are joined by their
hash. A document's windows that meet an item on one diagonal (document position less item
position) form one alignment; it counts only if its slots are consistent: each slot value of the
item stands for one value of the document and the reverse. So a question whose numbers or names
were exchanged throughout is still caught, while a chance mixture of values is not.

A document is contaminated by an item if consistent alignments cover at least 0.8 of the item's
windows. So of an item's n windows a document may miss n - ceil(0.8 n), and any set of one more than
these holds one that it has: candidates are found by that many windows of each item, those that the
fewest items share, and only candidates meet the others. A template that many items share is joined
with documents for none of them until a rare window has brought the two together.

Defined results: an item of two to four tokens is one window of its own length, in which all tokens
are literal, as so short a template would fit clean text; an item of one token, or of five or more
whose windows are all placeholders, has no window and matches nothing; null and empty texts match
nothing; repeated rows and repeated items match each for itself, by identifier.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.chunks import chunk_codes, listed, slices
from tessera.session import materialise, ship_package

WINDOW, SHORTEST, SHARE, FILTER_BITS = 5, 2, 0.8, 24
#: Fixed: spelt-out and abbreviated units that are recognised after a number.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec ms min h hr hrs day days week weeks month months year years hour hours minute minutes second seconds meter meters metre metres kilometers kilometres miles mile feet foot inch inches gram grams kilogram kilograms liter liters litre litres dollar dollars euro euros cent cents percent % degree degrees mph kmh w kw v hz °c °f usd eur $ €".split())
_NUMBER = regex.compile(r"[+-]?[$€£]?\d+(?:[.,:/]\d+)*(%|[\p{L}°$€]{1,4})?")
_EDGE = regex.compile(r"^[^\p{L}\p{N}$€£%+-]+|[^\p{L}\p{N}%$€]+$")
_END = regex.compile(r"[.!?:][\"')\]]*$")
#: Kinds of token, and the hashes that stand for the placeholders.
WORD, NUMBER, NAME, UNIT, NOTHING = range(5)
_PLACE = {k: xxhash.xxh64_intdigest(f"\0{k}", 1) for k in (NUMBER, NAME, UNIT)}
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(WINDOW)], np.uint64)


def classify(chunk: str) -> tuple[int, str, str | None]:
    """(kind, value, unit written together with a number or None); a name may turn out a word."""
    core = _EDGE.sub("", chunk)
    if not core or not any(c.isalnum() for c in core):
        return (UNIT, core, None) if core in UNITS else (NOTHING, "", None)
    if core[0] in "+-$€£0123456789" or core[0].isdigit():
        m = _NUMBER.fullmatch(core)
        if m:
            unit = m[1] if m[1] and m[1].lower() in UNITS else None
            if unit or not m[1]:
                return NUMBER, core[: len(core) - len(unit or "")], unit
    return (NAME if core[0].isupper() and any(c.islower() for c in core) else WORD), core.lower(), None


def canonical(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Template tokens of a batch: (document of each, hash, kind, index of its value, values, whether
    it would be a name if it did not begin its sentence, hash of its value)."""
    offsets, chunks, codes = chunk_codes(texts)
    kinds, hashes, values, units, ends = [], [], [], {}, []
    words = listed(chunks)
    for i, c in enumerate(words):
        kind, value, unit = classify(c)
        kinds.append(kind)
        values.append(value)
        hashes.append(xxhash.xxh64_intdigest(value, 1))
        ends.append(bool(_END.search(c)))
        if unit is not None:
            units[i] = unit.lower()
    unit_at = {}
    for u in dict.fromkeys(units.values()):
        unit_at[u] = len(values)
        kinds.append(UNIT)
        values.append(u)
        hashes.append(xxhash.xxh64_intdigest(u, 1))
        ends.append(False)
    kind = np.array([*kinds, NOTHING], np.int8)
    plain = np.array([*hashes, 0], np.uint64)
    ended = np.array([*ends, False])
    follows = np.full(len(kind), -1, np.int64)
    for i, u in units.items():
        follows[i] = unit_at[u]
    is_unit = np.array([v in UNITS for v in values] + [False])
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    code = codes.astype(np.int64)
    fused = follows[code] >= 0
    if fused.any():
        at = np.flatnonzero(fused) + 1
        code, doc = np.insert(code, at, follows[code[fused]]), np.insert(doc, at, doc[fused])
    first = np.concatenate(([True], (doc[1:] != doc[:-1]) | ended[code[:-1]])) if len(code) else np.zeros(0, bool)
    real = kind[code] != NOTHING
    begins = np.maximum.accumulate(np.where(first, np.arange(len(code)), -1)) if len(code) else np.zeros(0, np.int64)
    seen = np.cumsum(real) - real  # real tokens before this one
    opens = (seen - seen[begins] == 0) if len(code) else np.zeros(0, bool)
    doc, code, opens = doc[real], code[real], opens[real]
    k = kind[code]
    named = (k == NAME) & opens
    k = np.where(named, WORD, k)
    after_number = np.concatenate(([False], (k[:-1] == NUMBER) & (doc[1:] == doc[:-1]))) if len(k) else np.zeros(0, bool)
    k = np.where(after_number & is_unit[code], UNIT, np.where(k == UNIT, np.where(after_number, UNIT, WORD), k))
    h = plain[code]
    for place, value in _PLACE.items():
        h = np.where(k == place, np.uint64(value), h)
    return doc, h, k, code, pa.array(values, pa.string()), named, plain[code]


def windows(doc: np.ndarray, h: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of windows that stay in one document and hold a plain word."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    w, plain = np.zeros(n, np.uint64), np.zeros(n, bool)
    for i in range(WINDOW):
        w += h[i : i + n] * _POWERS[i]
        plain |= k[i : i + n] == WORD
    w ^= w >> np.uint64(29)
    at = np.flatnonzero((doc[:n] == doc[WINDOW - 1 :]) & plain)
    return at, w[at]


def literal_windows(doc: np.ndarray, own: np.ndarray, size: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of windows of `size` values, or of the documents that are one as a whole."""
    n = len(own) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    w = np.full(n, _PLACE[NUMBER] ^ size, np.uint64)
    for i in range(size):
        w = w * _POWERS[1] + own[i : i + n]
    w ^= w >> np.uint64(29)
    fits = doc[:n] == doc[size - 1 :]
    if whole:
        first = np.concatenate(([True], doc[1:] != doc[:-1]))
        last = np.concatenate((doc[1:] != doc[:-1], [True]))
        fits &= first[:n] & last[size - 1 :]
    at = np.flatnonzero(fits)
    return at, w[at]


_SCHEMA = "k {}, position long, size int, whash long, slots array<struct<kind:tinyint,value:string>>"


def template_windows(texts: DataFrame, key: str, text: str, keep=None, sizes: tuple[int, ...] = (), item: bool = False) -> DataFrame:
    """(k, position, size, whash, slots) of every window, or of those that `keep`, a broadcast bit
    field over the low bits of the hash, lets through; positions count from the document's first
    token. `sizes` are the lengths of literal windows that are wanted beside those of the template,
    which have no slots. With `item` the first window comes twice if its first token would be a name
    in the middle of another text's sentence, and a text shorter than a window is one literal window."""
    ship_package(texts.sparkSession)
    source = texts.select(F.col(key).alias("k"), F.col(text).alias("text"))
    sizes = tuple(range(SHORTEST, WINDOW)) if item else sizes

    def run(batches):
        bits = None if keep is None else np.frombuffer(keep.value, np.uint8)
        for batch in batches:
            for part in slices(batch, "text"):
                doc, h, kind, code, values, named, own = canonical(part.column("text"))
                start = np.searchsorted(doc, np.arange(part.num_rows))
                found = [(*windows(doc, h, kind), kind, WINDOW)]
                if item:
                    named &= np.concatenate(([True], doc[1:] != doc[:-1]))[: len(doc)]
                    kinds = np.where(named, NAME, kind)
                    at, w = windows(doc, np.where(named, np.uint64(_PLACE[NAME]), h), kinds)
                    found.append((at[named[at]], w[named[at]], kinds, WINDOW))
                found += [(*literal_windows(doc, own, n, item), None, n) for n in sizes]
                for at, w, kinds, size in found:
                    if bits is not None:
                        low = (w & np.uint64(8 * len(bits) - 1)).astype(np.int64)
                        hit = (bits[low >> 3] >> (low & 7).astype(np.uint8)) & 1 > 0
                        at, w = at[hit], w[hit]
                    inside = at[:, None] + np.arange(size)[None, :]
                    slot = np.zeros(inside.shape, bool) if kinds is None else kinds[inside] != WORD
                    chosen = inside[slot]
                    offsets = np.concatenate(([0], np.cumsum(slot.sum(axis=1))))
                    pairs = pa.StructArray.from_arrays([pa.array(kind[chosen] if kinds is None else kinds[chosen], pa.int8()), values.take(pa.array(code[chosen]))], names=["kind", "value"])
                    slots = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
                    yield pa.RecordBatch.from_arrays([part.column("k").take(pa.array(doc[at])), pa.array(at - start[doc[at]], pa.int64()), pa.array(np.full(len(at), size, np.int32)), pa.array(w.view(np.int64)), slots], names=["k", "position", "size", "whash", "slots"])

    return source.mapInArrow(run, _SCHEMA.format(source.schema["k"].dataType.simpleString()))


def bit_field(hashes: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """A bit field of 2**bits bits, 2 MB, whatever the number of hashes: what passes it by chance is
    dropped by the join. Built by an aggregate over words of 64 bits."""
    low = F.col("whash").bitwiseAND(F.lit((1 << bits) - 1))
    words = hashes.select(F.shiftright(low, 6).alias("word"), F.expr("shiftleft(1L, cast(whash & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("value"))
    field = np.zeros(1 << (bits - 6), np.int64)
    for r in words.toLocalIterator():  # at most 2**18 rows
        field[r.word] = r.value
    return field.astype("<i8").tobytes()


def candidates(met: DataFrame, items: DataFrame, total: DataFrame, share: float) -> DataFrame:
    """(k, item_id) of every document that has one of the item's rarest windows, one more of them than
    it may miss. A window's rarity is the number of items that hold it, so the windows of a template
    that many items share come last."""
    held = items.select("whash", "item_id").distinct().groupBy("whash").agg(F.count("*").alias("held"))
    rarity = items.join(held, "whash").groupBy("item_id", "item_position").agg(F.max("held").alias("held")).join(total, "item_id")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy("held", "item_position"))
    chosen = rarity.withColumn("place", place).where(F.col("place") <= F.col("windows") - F.ceil(F.col("windows") * share - 1e-9) + 1)
    rare = items.join(chosen.select("item_id", "item_position"), ["item_id", "item_position"]).select("whash", "item_id").distinct()
    return met.select("k", "whash").distinct().join(rare, "whash").select("k", "item_id").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, matched, windows, coverage, exact) of every document and item that it holds.

    exact: all slots hold the item's own values. The bit field, of fixed size, passes over most
    windows before anything is written; the rest meet the rarest windows of each item, and the pairs
    of document and item that these give meet all windows of the item.
    """
    spark = docs.sparkSession
    ship_package(spark)
    items = materialise(template_windows(benchmark, item_key, item_text, item=True), "items").withColumnsRenamed({"k": "item_id", "position": "item_position", "slots": "item_slots"})
    total = items.groupBy("item_id").agg(F.countDistinct("item_position").alias("windows"))
    keep = spark.sparkContext.broadcast(bit_field(items.select("whash").distinct()))
    sizes = tuple(r["size"] for r in items.where(F.col("size") < WINDOW).select("size").distinct().collect())  # three at most
    met = materialise(template_windows(docs, key, text, keep, sizes).drop("size"), "met")
    wanted = candidates(met, items, total, share).join(items.select("item_id", "item_position", "whash", "item_slots"), "item_id")
    wanted = wanted.select(F.col("k").alias("w_k"), "item_id", "item_position", F.col("whash").alias("w_hash"), "item_slots")
    hits = met.join(wanted, F.col("k").eqNullSafe(F.col("w_k")) & (F.col("whash") == F.col("w_hash")))
    hits = materialise(hits.select("k", "item_id", "item_position", (F.col("position") - F.col("item_position")).alias("diagonal"), F.arrays_zip("slots", "item_slots").alias("pairs")), "hits")
    slots = hits.select("k", "item_id", "diagonal", F.explode("pairs").alias("p")).select("k", "item_id", "diagonal", F.col("p.slots.kind").alias("kind"), F.col("p.slots.value").alias("ours"), F.col("p.item_slots.value").alias("theirs")).distinct()
    by = ["k", "item_id", "diagonal"]
    clash = slots.groupBy(*by, "kind", "theirs").agg(F.count("*").alias("n")).where("n > 1").select(*by).unionByName(slots.groupBy(*by, "kind", "ours").agg(F.count("*").alias("n")).where("n > 1").select(*by)).distinct()
    same = F.forall("pairs", lambda p: p["slots"]["value"] == p["item_slots"]["value"])
    clash = clash.select(*[F.col(c).alias(f"c_{c}") for c in by])
    held = hits.join(clash, (F.col("k") == F.col("c_k")) & (F.col("item_id") == F.col("c_item_id")) & (F.col("diagonal") == F.col("c_diagonal")), "left_anti")
    sound = held.select("k", "item_id", "item_position", same.alias("same"))
    found = sound.groupBy("k", "item_id").agg(F.countDistinct("item_position").alias("matched"), F.countDistinct(F.when(F.col("same"), F.col("item_position"))).alias("own"))
    found = found.join(total, "item_id").withColumn("coverage", F.col("matched") / F.col("windows")).where(F.col("coverage") >= share)
    return found.select(F.col("k").alias(key), "item_id", "matched", "windows", "coverage", (F.col("own") >= F.col("windows") * share).alias("exact"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs whose text holds no item, whatever their identifiers."""
    marked = docs.withColumn("__text", F.xxhash64(text))
    bad = contaminated(marked.select("__text", F.col(text).alias("text")), benchmark, share, "__text", "text").select(F.col("__text").alias("__bad")).distinct()
    return marked.join(bad, F.col("__text") == F.col("__bad"), "left_anti").drop("__text")
