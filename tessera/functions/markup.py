"""Rule-based extraction of HTML, XML and plain text with the standard library's parsers."""

from __future__ import annotations

from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed: elements without running text, elements around the main text, elements that break lines.
SKIPPED = frozenset("script style noscript template svg nav header footer aside form button select".split())
BREAKS = frozenset("p div section article main h1 h2 h3 h4 h5 h6 li ul ol table tr blockquote pre br figure figcaption dl dt dd hr".split())
EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.line, self.skip, self.title, self.headings = [], [], [], "", []
        self.in_title, self.heading, self.cells = False, None, False

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skip.append(tag)
        if tag == "title":
            self.in_title = True
        if tag in ("td", "th"):
            if self.cells:
                self.line.append(" | ")
            self.cells = True
        elif tag in BREAKS:
            self.end_line()
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.heading = len(self.lines)

    def handle_endtag(self, tag):
        if self.skip and tag == self.skip[-1]:
            self.skip.pop()
        if tag == "title":
            self.in_title = False
        if tag in BREAKS:
            self.end_line()
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.heading is not None:
            self.headings += self.lines[self.heading :]
            self.heading = None

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.skip:
            self.line.append(data)

    def end_line(self):
        text = " ".join("".join(self.line).split())
        if text:
            self.lines.append(text)
        self.line, self.cells = [], False


def extract_html(body: str) -> dict:
    r = _Reader()
    r.feed(body)
    r.close()
    r.end_line()
    return {"title": " ".join(r.title.split()), "text": "\n".join(r.lines), "headings": r.headings, "parser": "html"}


def extract_xml(body: str) -> dict:
    """The text of every element in order; tables and references of articles stay in place."""
    root = ElementTree.fromstring(body)
    title = next((" ".join("".join(e.itertext()).split()) for e in root.iter() if e.tag.rpartition("}")[2] in ("article-title", "title")), "")
    lines = [" ".join("".join(e.itertext()).split()) for e in root.iter() if e.tag.rpartition("}")[2] in ("p", "title", "article-title")]
    return {"title": title, "text": "\n".join(x for x in lines if x), "headings": [], "parser": "xml"}


def extract_source(body: str | None, content_type: str = "text/html") -> dict:
    """Title, text, headings and the parser used; a body that cannot be read has an error instead."""
    if not body:
        return {"title": "", "text": "", "headings": [], "parser": "none"}
    kind = content_type.lower()
    if "xml" in kind and "html" not in kind:
        try:
            return extract_xml(body)
        except ElementTree.ParseError:
            return extract_html(body)
    if "html" in kind or body.lstrip()[:1] == "<":
        return extract_html(body)
    return {"title": "", "text": body, "headings": [], "parser": "plain"}


def extract(pages: DataFrame, key: str, body: str, url: str, content_type: str | None = None) -> DataFrame:
    """(key, url, title, text, headings, parser) of every page; content_type is the column that names the
    kind of the body, where there is one: markup as XML or HTML, all else as plain text. A null kind is
    text/html."""

    @F.pandas_udf("struct<title:string,text:string,headings:array<string>,parser:string>")
    def read(bodies: pd.Series, kinds: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extract_source(b, k) for b, k in zip(bodies, kinds, strict=True)], columns=["title", "text", "headings", "parser"])

    kind = F.coalesce(F.col(content_type) if content_type else F.lit(None).cast("string"), F.lit("text/html"))
    return pages.select(key, url, read(F.col(body), kind).alias("r")).select(key, url, "r.*")
