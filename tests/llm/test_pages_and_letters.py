"""Pages of any markup in linear time, the labeller against a plain forward pass, and letters of any plane."""

import math
import re
import time
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tessera.llm import blocks, languages, registry

HOSTILE = {
    "open tags and one quote": "<b " * 333_333 + '"',
    "open divs": "<div>x" * 20_000,
    "named open divs": '<div class="a b c d e f g">x' * 20_000,
    "stray end tags": "<span>" * 100_000 + "</div>x" * 100_000,
    "end tags of another block": "<div><b></div>" + "<i>" * 100_000 + "</b>x" * 100_000,
    "odd quotes": '<b "' * 200_000,
    "scripts": "<script " * 100_000,
    "script ends": "</script " * 100_000,
    "comments": "<!--" * 200_000,
    "classes": "<p " + "class=" * 150_000 + ">x",
    "quoted classes": "<p " + 'class=" ' * 150_000 + ">x",
    "brackets": "<" * 1_000_000,
    "paragraphs": "<p>x" * 200_000,
}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_time_grows_with_the_page(name):
    page = HOSTILE[name]
    began = time.process_time()
    blocks.leaf_blocks(page[: len(page) // 4])
    quarter = time.process_time() - began
    began = time.process_time()
    blocks.leaf_blocks(page)
    assert time.process_time() - began < max(1.0, 8 * quarter) + 1


def test_references_of_any_length():
    assert blocks.decoded("&#" + "1" * 1_000_000 + ";") == "�"
    assert blocks.decoded("&#x" + "f" * 5000 + ";a") == "�a"
    assert blocks.decoded("&#" + "0" * 9000 + "65;&#x00000000000041") == "AA"
    assert blocks.decoded("&#99999999;&#65;&amp &eacute;") == "�A& é"


def test_an_unclosed_quote_is_a_character():
    assert [b.text for b in blocks.leaf_blocks('<p title="x>one<p>two')] == ["one", "two"]
    assert [b.text for b in blocks.leaf_blocks('<p title="x>one<p y="z">two')] == ["two"]  # it ends at the next one


def plain_features(page, i):
    """The vector of block i of a page, written out."""
    b, n = page[i], len(page)
    x = np.zeros(blocks.WIDTH)
    for f in b.path:
        x[f] = 1
    words = b.text.split()
    for w in words:
        core = w.strip(blocks._AROUND).lower()
        if core:
            x[blocks.PATH + xxhash.xxh3_64_intdigest(core.encode()) % blocks.WORDS] += 1
    x[blocks.PATH : blocks.PATH + blocks.WORDS] = np.log1p(x[blocks.PATH : blocks.PATH + blocks.WORDS]) / math.log1p(max(len(words), 1))
    heading = b.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
    x[blocks.PATH + blocks.WORDS :] = [math.log1p(min(len(b.text), 3000)) / 6, math.log1p(min(len(words), 500)) / 4, b.linked, b.text[-1] in ".!?…。", heading, i / n, min(i, 20) / 20, min(n - i, 20) / 20, len(b.text) > 200, 1]
    return x


def plain_logits(net, page):
    """A bidirectional LSTM, block by block, in double precision."""
    h = blocks.HIDDEN_UNITS
    out = np.zeros((len(page), 2 * h))
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    for k, d in enumerate("fb"):
        hidden, cell = np.zeros(h), np.zeros(h)
        for i in range(len(page)) if d == "f" else range(len(page) - 1, -1, -1):
            z = plain_features(page, i) @ net.p["W" + d] + net.p["c" + d] + hidden @ net.p["U" + d]
            for j in range(h):
                cell[j] = sigmoid(z[h + j]) * cell[j] + sigmoid(z[j]) * math.tanh(z[3 * h + j])
                hidden[j] = sigmoid(z[2 * h + j]) * math.tanh(cell[j])
            out[i, k * h : (k + 1) * h] = hidden
    return out @ net.p["o"] + net.p["k"][0]


def test_query_equals_a_plain_forward_pass(spark, sf_dir):
    net = blocks.trained_in_task(spark)
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    compared = 0
    for r in registry.queries()["op2_main_text"](spark, sf_dir).collect():
        page = blocks.leaf_blocks(html[r.page_id])
        z = plain_logits(net, page)
        if (abs(z) < 1e-3).any():
            continue  # float32 may fall either way
        want = "\n".join(b.text for b, v in zip(page, z, strict=True) if v > 0)
        assert (r.text, r.n_chars) == (want, len(want))
        compared += 1
    assert compared > 0.95 * len(html)


def test_a_logit_of_zero_is_no_article():
    net = blocks.Labeller(np.random.default_rng(0))
    net.p["o"][:] = 0
    assert not net.label([blocks.leaf_blocks("<p>one<p>two")])[0].any()


def test_letters_are_of_category_l(spark):
    assert all(languages._LETTER[i] == (unicodedata.category(chr(i))[0] == "L") for i in range(0, 0x110000, 7))
    rows = [(1, "́ ́"), (2, chr(0x31350) * 5), (3, chr(0x30000)), (4, "́a"), (5, "1 2."), (6, None), (7, ""), (8, "\U000e0101")]
    docs = spark.createDataFrame([(100, "one two three", "en"), (101, "eins zwei drei", "de")], "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in languages.identify(spark.createDataFrame(rows, "doc_id long, text string"), *languages.fit(docs)).collect()}
    assert {k for k, v in found.items() if v == ("und", 0.0)} == {1, 5, 6, 7, 8}
    assert all(found[k][0] in ("en", "de") for k in (2, 3, 4))


def test_equal_languages_go_to_the_first_in_order(spark):
    docs = spark.createDataFrame([(1, "abc abd", "y"), (2, "abc abd", "x")], "doc_id long, text string, lang string")
    assert languages.identify(docs, *languages.fit(docs)).select("lang_pred").distinct().collect()[0].lang_pred == "x"


def plain_trigrams(text):
    kept = "".join((c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] in "LM" else " " for c in text)
    padded = " " + re.sub(" +", " ", kept.lstrip()) + " "  # one separator after each word that has any
    out = Counter()
    for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
        h = (ord(a) * 0x9E3779B1 + ord(b) * 0x85EBCA77 + ord(c) * 0xC2B2AE3D) * 0x27D4EB2F165667C5 % (1 << 64)
        out[(h >> 40) % languages.FEATURES] += 1
    return out, sum(unicodedata.category(c)[0] == "L" for c in text)


def test_trigrams_equal_plain_ones():
    texts = ["A bc, DÉF! İx ǅ", "", None, "x", "a" * 100_000, "1 2 3", "ée ́", chr(0x31350) + "\U0001f600" + "ß", "çà et là\tici\n"]
    doc, feature, count, letters = languages.trigrams(pa.array(texts))
    got = {}
    for d, f, n in zip(doc.tolist(), feature.tolist(), count.tolist(), strict=True):
        got.setdefault(d, Counter())[f] = n
    for i, t in enumerate(texts):
        grams, n = plain_trigrams(t or "")
        assert got.get(i, Counter()) == (grams if (t or "").strip() and n else Counter()) and letters[i] == n, t
