"""Children and parents by token budget, inside sections, at paragraph and sentence bounds."""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import spans
from tessera.session import ship_package


class Layout:
    """Where the tokens, sections, paragraphs and sentences of a text begin and end."""

    def __init__(self, text: str, tokenizer, headings: frozenset[str]):
        at = tokenizer.offsets(text)
        self.starts, self.ends = [a for a, _ in at], [b for _, b in at]
        self.paragraphs = {b for _, b in spans.paragraph_spans(text)}
        self.openings = {a for a, _ in spans.paragraph_spans(text)}
        self.sentences = {b for _, b in spans.sentence_spans(text)}
        lines, offset, cuts = text.split("\n"), 0, [0]
        for line in lines:
            if line.strip() in headings and offset:
                cuts.append(offset)
            offset += len(line) + 1
        self.sections = [(a, b) for a, b in ((bisect.bisect_left(self.starts, x), bisect.bisect_left(self.starts, y)) for x, y in zip(cuts, [*cuts[1:], len(text) + 1], strict=True)) if a < b]

    def snapped_end(self, least: int, most: int) -> int:
        """The last token count in (least, most] at which a paragraph ends, else a sentence, else most."""
        for ends in (self.paragraphs, self.sentences):
            for j in range(most, least, -1):
                if self.ends[j - 1] in ends:
                    return j
        return most


def children(layout: Layout, size: int, overlap: int) -> list[tuple[int, int, int]]:
    """(section, first token, end token): windows of at most `size` tokens that stay in a section. An
    end is moved back to a paragraph's or sentence's in the window's second half; the next window
    begins about `overlap` tokens before it."""
    out = []
    for number, (first, last) in enumerate(layout.sections):
        i = first
        while True:
            j = min(i + size, last)
            j = j if j == last else layout.snapped_end(i + size // 2, j)
            out.append((number, i, j))
            if j == last:
                break
            i = max(i + 1, j - overlap)
    return out


def parent(layout: Layout, child: tuple[int, int, int], size: int) -> tuple[int, int]:
    """(first token, end token) of the child's section around it, centred, at most `size` tokens (the
    child itself, if it has more); ends move inwards to paragraph bounds outside the child."""
    number, i, j = child
    first, last = layout.sections[number]
    room = max(0, size - (j - i))
    a = max(first, min(i - room // 2, last - size))
    b = min(last, max(a + size, j))
    a, b = min(a, i), max(b, j)
    if a > first:
        a = next((k for k in range(a, i) if layout.starts[k] in layout.openings), a)
    if b < last:
        b = next((k for k in range(b, j, -1) if layout.ends[k - 1] in layout.paragraphs), b)
    return a, b


def chunked(docs: DataFrame, key: str, text: str, size: int = 180, overlap: int = 40, parent_size: int = 512, headings: list[str] = (), tokenizer=None) -> DataFrame:
    """One row a child: key, chunk_order, section, start_char, end_char, token_count, text, and its
    parent_start, parent_end and parent_tokens. Null texts and texts without tokens have none."""
    ship_package(docs.sparkSession)
    tokenizer, known = tokenizer or spans.WordTokenizer(), frozenset(headings)

    def spans_of(t):
        if not t:
            return []
        layout, out = Layout(t, tokenizer, known), []
        for child in children(layout, size, overlap):
            (number, i, j), (a, b) = child, parent(layout, child, parent_size)
            out.append({"section": number, "start_char": layout.starts[i], "end_char": layout.ends[j - 1], "token_count": j - i, "parent_start": layout.starts[a], "parent_end": layout.ends[b - 1], "parent_tokens": b - a})
        return out

    @F.pandas_udf("array<struct<section:int,start_char:int,end_char:int,token_count:int,parent_start:int,parent_end:int,parent_tokens:int>>")
    def find(texts: pd.Series) -> pd.Series:
        return texts.map(spans_of)

    rows = docs.select(key, F.col(text).alias("__t"), F.posexplode(find(F.col(text))).alias("chunk_order", "s")).select(key, "__t", "chunk_order", "s.*")
    return rows.withColumn("text", F.substring("__t", F.col("start_char") + 1, F.col("end_char") - F.col("start_char"))).drop("__t")
