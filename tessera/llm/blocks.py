"""Main-text extraction by a recurrent block labeller.

A page is cut into its leaf blocks, the runs of text between block-level tags. Each block becomes a
vector of its tag path (hashed names, classes and identifiers of its ancestors), of its hashed words
and of its shape. A bidirectional LSTM in numpy reads the vectors of the whole page in order and
says of every block whether it belongs to the article. The network is trained here, on generated
pages of many layouts, the same for the same seed.

Character references are decoded, white space in a block becomes one space, blocks of the article
are joined by one line feed in page order. Defined results: a null or empty page, and one without
text, give the empty string; unclosed and stray tags, cut-off pages and very long ones are read as
far as they go, in time that grows with their length; a quote in a tag that nothing closes is an
ordinary character; a block whose logit is zero is not article; repeated rows are extracted each;
nothing is dropped by length.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.chunks import chunk_codes, listed, slices
from tessera.session import ship_package

#: Fixed by HTML: elements that begin a block of their own, that hold no running text, that are void.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = ("script", "style", "noscript", "template", "svg", "math", "textarea", "select", "button", "iframe", "object", "canvas", "audio", "video", "title", "datalist")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Fixed by HTML: what an opening tag closes if it is open.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_OPEN = re.compile(r"<!--|<[!?]|<(" + "|".join(HIDDEN) + r")\b|<(/?)([a-z][^\s/>]*+)", re.I)
_STOP = re.compile(r"[>\"']")
_ENDS = {t: re.compile(rf"</{t}\s*+>", re.I) for t in HIDDEN}
_LONG_REFERENCE = re.compile(r"&#(?:([0-9]{9,})|[xX]([0-9a-fA-F]{9,}));?")
_HINTS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")

PATH, WORDS, SHAPE, HIDDEN_UNITS = 448, 512, 10, 24
WIDTH = PATH + WORDS + SHAPE
PAGES, EPOCHS, BATCH, SEED = 3000, 7, 24, 5


def _hash(text: str, n: int) -> int:
    return zlib.crc32(text.encode()) % n


class Block:
    __slots__ = ("path", "text", "linked", "tag")

    def __init__(self, path, text, linked, tag):
        self.path, self.text, self.linked, self.tag = path, text, linked, tag


def _long_reference(m: re.Match) -> str:
    """A reference of so many digits that it is out of range, but for leading zeros."""
    digits = (m[1] or m[2]).lstrip("0")
    return "\ufffd" if len(digits) > 8 else f"&#{'x' if m[2] else ''}{digits or '0'};"


def decoded(text: str) -> str:
    """Character references decoded, white space made single spaces, trimmed."""
    return " ".join(entities.unescape(_LONG_REFERENCE.sub(_long_reference, text)).split())


def tags(page: str):
    """Yield (start, end, name, closing, attributes) of every tag, comment and hidden element in order; the
    name is None where nothing but the extent counts. Each character is looked at a bounded number of
    times: what is found is never read again, and a quote that does not recur is remembered."""
    at, lone = 0, set()
    while m := _OPEN.search(page, at):
        i = m.end()
        if m[1] is None and m[3] is None:
            to = page.find("-->", i) if m[0] == "<!--" else page.find(">", i)
            at = len(page) if to < 0 else to + (3 if m[0] == "<!--" else 1)
            yield m.start(), at, None, False, ""
            continue
        inside = i
        while stop := _STOP.search(page, i):
            if stop[0] == ">":
                break
            i = stop.end()
            if stop[0] not in lone:
                to = page.find(stop[0], i)
                if to < 0:
                    lone.add(stop[0])  # an unclosed quote is an ordinary character
                else:
                    i = to + 1
        until, at = (stop.start(), stop.end()) if stop else (len(page), len(page))
        if m[1] is None:
            yield m.start(), at, m[3].lower(), bool(m[2]), page[inside:until]
        else:
            end = _ENDS[m[1].lower()].search(page, at) if m[1].lower() in _ENDS else None
            at = end.end() if end else len(page)
            yield m.start(), at, None, False, ""


class _Open:
    """The open elements. All it is asked costs the same at any depth: the innermost block element, the
    innermost element of a name, and the features of all that is open, kept as counts."""

    def __init__(self):
        self.stack, self.blocks, self.places, self.counts, self.links, self.path = [], [], {}, {}, 0, None

    def push(self, tag: str, features: tuple[int, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, features))
        self.links += tag == "a"
        for f in features:
            self.counts[f] = self.counts.get(f, 0) + 1
        self.path = None

    def close(self, to: int) -> None:
        while len(self.stack) > to:
            tag, features = self.stack.pop()
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
            self.links -= tag == "a"
            for f in features:
                self.counts[f] -= 1
                if not self.counts[f]:
                    del self.counts[f]
        self.path = None

    def block(self) -> str | None:
        return self.stack[self.blocks[-1]][0] if self.blocks else None

    def closing(self, tag: str) -> None:
        """What an end tag closes: the innermost element of its name, for an inline one within its block."""
        place = self.places.get(tag)
        if place and (tag in BLOCK or not self.blocks or place[-1] > self.blocks[-1]):
            self.close(place[-1])

    def features(self) -> tuple[int, ...]:
        if self.path is None:
            self.path = tuple(self.counts)
        return self.path


def leaf_blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order: features of the tag path, text, characters inside links. Work
    grows with the length of the page whatever its markup."""
    out: list[Block] = []
    opened = _Open()
    raw: list[str] = []
    linked = 0
    memo: dict[str, tuple[int, ...]] = {}

    def end_block() -> None:
        nonlocal linked
        if raw:
            text = decoded("".join(raw))
            if text:
                out.append(Block(opened.features(), text, min(1.0, linked / len(text)), opened.block() or "body"))
            raw.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        raw.append(text)
        if opened.links:
            linked += len(text)

    page = page or ""
    at = 0
    for start, end, tag, closing, attributes in tags(page):
        if start > at:
            add(page[at:start])
        at = end
        if tag is None:
            continue
        if tag == "head" and not closing:
            end_block()
            continue
        if tag == "br":
            add(" ")
            continue
        block = tag in BLOCK
        if block:
            end_block()
        if closing:
            opened.closing(tag)
        elif tag not in VOID:
            if block and (opened.block() == "p" or opened.block() in CLOSES.get(tag, ())):
                opened.close(opened.blocks[-1])
            key = tag + attributes
            features = memo.get(key)
            if features is None:
                names = {"<" + tag}
                for a, b, c in _HINTS.findall(attributes):
                    names |= {"." + x for x in _PARTS.findall((a or b or c).lower())}
                features = memo[key] = tuple(_hash(x, PATH) for x in names)
            opened.push(tag, features)
    rest = page[at:]
    if rest and not re.match(r"<[a-zA-Z/!?]", rest):
        add(rest)
    end_block()
    return out


def _hash_words(words: pa.Array) -> np.ndarray:
    """A place among WORDS for each whole word, lower-cased and without punctuation around it; one
    place more for mere punctuation."""
    cores = [w.strip(_AROUND).lower() for w in listed(words)]
    return np.array([xxhash.xxh3_64_intdigest(w) % WORDS if w else WORDS for w in cores], np.int64)


def features(pages: list[list[Block]], start: int = 0, stop: int | None = None) -> np.ndarray:
    """One row of WIDTH for each block of all pages, in order; of one page also of a part of it."""
    blocks = [b for p in pages for b in p[start:stop]]
    x = np.zeros((len(blocks), WIDTH), np.float32)
    if not blocks:
        return x
    rows = np.repeat(np.arange(len(blocks)), [len(b.path) for b in blocks])
    x[rows, np.array([i for b in blocks for i in b.path], np.int64)] = 1
    offsets, chunks, codes = chunk_codes(pa.array([b.text for b in blocks]))
    place = np.append(_hash_words(chunks), 0)
    n = np.diff(offsets)
    rows = np.repeat(np.arange(len(blocks)), n)
    counts = np.bincount(rows * (WORDS + 1) + place[codes], minlength=len(blocks) * (WORDS + 1)).reshape(-1, WORDS + 1)[:, :WORDS]
    x[:, PATH : PATH + WORDS] = np.log1p(counts) / np.log1p(np.maximum(n, 1))[:, None]
    length = np.array([len(b.text) for b in blocks])
    at = np.concatenate([np.arange(len(p))[start:stop] for p in pages])
    size = np.repeat([len(p) for p in pages], [len(p[start:stop]) for p in pages])
    last = [b.text[-1] in ".!?…。" for b in blocks]
    heading = [b.tag in ("h1", "h2", "h3", "h4", "h5", "h6") for b in blocks]
    shape = [np.log1p(np.minimum(length, 3000)) / 6, np.log1p(np.minimum(n, 500)) / 4, [b.linked for b in blocks], last, heading, at / size, np.minimum(at, 20) / 20, np.minimum(size - at, 20) / 20, length > 200, np.ones(len(blocks))]
    x[:, PATH + WORDS :] = np.stack([np.asarray(s, np.float32) for s in shape], axis=1)
    return x


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """A bidirectional LSTM over the blocks of pages, with one logistic output a block."""

    def __init__(self, rng):
        h = HIDDEN_UNITS
        self.p = {}
        for d in ("f", "b"):
            self.p["W" + d] = (rng.standard_normal((WIDTH, 4 * h)) * 0.1).astype(np.float32)
            self.p["U" + d] = (rng.standard_normal((h, 4 * h)) * 0.2).astype(np.float32)
            self.p["c" + d] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32)
        self.p["o"] = (rng.standard_normal(2 * h) * 0.2).astype(np.float32)
        self.p["k"] = np.zeros(1, np.float32)

    def _run(self, z, mask, u, keep, state=None):
        """Hidden states of one direction and its last state; z: projected inputs, padded (time, page, 4h)."""
        h = HIDDEN_UNITS
        t, n = mask.shape
        hidden, cell = state or (np.zeros((n, h), np.float32), np.zeros((n, h), np.float32))
        out, saved = np.zeros((t, n, h), np.float32), []
        for s in range(t):
            g = z[s] + hidden @ u
            gates = _sigmoid(g[:, : 3 * h])
            i, f, o, new = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :], np.tanh(g[:, 3 * h :])
            m = mask[s][:, None]
            before = cell
            grown = f * cell + i * new
            squashed = np.tanh(grown)
            if keep:
                saved.append((hidden, before, i, f, o, new, squashed, m))
            cell = np.where(m, grown, cell)
            hidden = np.where(m, o * squashed, hidden)
            out[s] = hidden
        return out, saved, (hidden, cell)

    def _back(self, grad, saved, u):
        h = HIDDEN_UNITS
        dz = np.zeros(grad.shape[:2] + (4 * h,), np.float32)
        du = np.zeros_like(u)
        dh = dc = np.zeros(grad.shape[1:], np.float32)
        for s in range(len(saved) - 1, -1, -1):
            hidden, before, i, f, o, new, squashed, m = saved[s]
            dh = dh + grad[s]
            live_h, live_c = np.where(m, dh, 0), np.where(m, dc, 0)
            live_c = live_c + live_h * o * (1 - squashed**2)
            d = np.concatenate([live_c * new * i * (1 - i), live_c * before * f * (1 - f), live_h * squashed * o * (1 - o), live_c * i * (1 - new**2)], axis=1)
            dz[s] = d
            du += hidden.T @ d
            dh = np.where(m, d @ u.T, dh)
            dc = np.where(m, live_c * f, dc)
        return dz, du

    def _padded(self, sizes):
        """(positions of blocks in forward order, in backward order, mask), each (time, page)."""
        t = int(sizes.max())
        starts = np.cumsum(sizes) - sizes
        step = np.arange(t)[:, None]
        mask = step < sizes[None, :]
        forward = np.where(mask, starts[None, :] + step, 0)
        backward = np.where(mask, starts[None, :] + sizes[None, :] - 1 - step, 0)
        return forward, backward, mask

    def logits(self, x: np.ndarray, sizes: np.ndarray, keep: bool = False):
        """One logit a block; sizes: blocks of each page, none empty."""
        forward, backward, mask = self._padded(sizes)
        outs, caches = [], []
        for d, at in (("f", forward), ("b", backward)):
            z = x @ self.p["W" + d] + self.p["c" + d]
            hidden, saved, _ = self._run(z[at], mask, self.p["U" + d], keep)
            flat = np.zeros((len(x), HIDDEN_UNITS), np.float32)
            flat[at[mask]] = hidden[mask]
            outs.append(flat)
            caches.append((at, saved))
        both = np.concatenate(outs, axis=1)
        return both @ self.p["o"] + self.p["k"], both, caches, mask

    def long_logits(self, page: list[Block], part: int) -> np.ndarray:
        """logits of one page whose blocks do not fit at once: features and projections are made for
        `part` blocks at a time, and the state is carried on in either direction."""
        both = np.zeros((len(page), 2 * HIDDEN_UNITS), np.float32)
        starts = range(0, len(page), part)
        for k, (d, order, step) in enumerate((("f", starts, 1), ("b", reversed(starts), -1))):
            state = None
            for a in order:
                z = features([page], a, a + part)[::step] @ self.p["W" + d] + self.p["c" + d]
                hidden, _, state = self._run(z[:, None], np.ones((len(z), 1), bool), self.p["U" + d], False, state)
                both[a : a + part, k * HIDDEN_UNITS : (k + 1) * HIDDEN_UNITS] = hidden[::step, 0]
        return both @ self.p["o"] + self.p["k"]

    def gradients(self, x, sizes, y):
        z, both, caches, mask = self.logits(x, sizes, keep=True)
        error = ((_sigmoid(z) - y) / len(y)).astype(np.float32)
        g = {"o": both.T @ error, "k": error.sum(keepdims=True)}
        dboth = error[:, None] * self.p["o"][None, :]
        for d, (at, saved), part in zip(("f", "b"), caches, (dboth[:, :HIDDEN_UNITS], dboth[:, HIDDEN_UNITS:]), strict=True):
            dz, g["U" + d] = self._back(part[at] * mask[..., None], saved, self.p["U" + d])
            flat = np.zeros((len(x), 4 * HIDDEN_UNITS), np.float32)
            flat[at[mask]] = dz[mask]
            g["W" + d], g["c" + d] = x.T @ flat, flat.sum(axis=0)
        return g

    def label(self, pages: list[list[Block]], blocks: int = 16_384) -> list[np.ndarray]:
        """For each page, which of its blocks belong to the article. Pages of like length share a
        batch of about `blocks` blocks, padding included."""
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        out = [np.zeros(0, bool)] * len(pages)
        while order:
            n = 1
            while n < len(order) and (n + 1) * len(pages[order[n]]) <= blocks:
                n += 1
            batch, order = order[:n], order[n:]
            chosen = [pages[i] for i in batch]
            sizes = np.array([len(p) for p in chosen])
            z = self.logits(features(chosen), sizes)[0] if sizes.sum() <= blocks else self.long_logits(chosen[0], blocks)
            for i, part in zip(batch, np.split(z > 0, np.cumsum(sizes)[:-1]), strict=True):
                out[i] = part
        return out


#: Vocabulary of the generator: hints that real layouts give, by part of the page.
_NOISE = {
    "nav": "nav menu navbar navigation topnav breadcrumb breadcrumbs links",
    "header": "header masthead top site branding logo banner",
    "footer": "footer bottom copyright legal colophon site",
    "sidebar": "sidebar aside widget rail secondary side column related recommended popular trending more",
    "notice": "notice cookie consent gdpr alert message popup modal overlay banner warning newsletter subscribe paywall",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense dfp banner",
    "form": "form login search signup contact newsletter subscribe feedback",
    "comments": "comments comment reply replies discussion disqus respond thread user",
    "share": "share social tags toolbar byline meta follow",
}
#: Words that mark such parts of a page in real text.
_CUES = {
    "nav": "home about contact news products services login menu archive next previous",
    "header": "welcome official daily online edition search login",
    "footer": "copyright rights reserved privacy terms imprint sitemap policy company",
    "sidebar": "related popular recent posts categories also recommended latest more",
    "notice": "cookies cookie consent accept privacy settings agree subscribe subscription continue",
    "ad": "sponsored advertisement buy offer sale discount promoted free shipping deal",
    "form": "name email password submit send address required sign register",
    "comments": "reply says commented comments ago report likes thanks guest",
    "share": "share tweet facebook print follow copy link whatsapp",
}
#: Frequent words of some languages, which say nothing about a block.
_COMMON = (
    "the of and to in is was for on that with as it at by from this be are or an have not which you "
    "de la le et les des en un une du que qui dans pour par sur est au aux ne pas se ce il elle avec "
    "der die das und in den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus "
    "el los las y del se por con una su para es al lo como más pero sus o este sí porque"
)
_AROUND = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»…©"
_NOISE_TAGS = {"nav": ("nav", "div", "ul"), "header": ("header", "div"), "footer": ("footer", "div"), "sidebar": ("aside", "div", "section"), "notice": ("div", "section", "aside"), "ad": ("div", "aside", "section", "ins"), "form": ("form",), "comments": ("section", "div", "ol"), "share": ("div", "ul")}
_MAIN = "article content main post entry story body text page single news blog"


def _generated(rng: np.random.Generator) -> tuple[str, list[tuple[str, bool]]]:
    """A page and its (text, belongs to the article) in order."""
    syllables = "an er in on re th es ti or ea al la de un que con sch ung ein ment eau ra lo mi ka su".split()
    common = _COMMON.split()
    pick = lambda a: a[int(rng.integers(len(a)))]
    truth: list[tuple[str, bool]] = []

    part = ["main"]

    def words(n):
        made = ["".join(pick(syllables) for _ in range(int(rng.integers(1, 5)))) for _ in range(n)]
        for i, r in enumerate(rng.random(n)):  # words of any part: frequent ones, and any others
            made[i] = pick(common) if r < 0.3 else "".join(pick("abcdefghijklmnopqrstuvwxyzéèüößñç") for _ in range(int(rng.integers(2, 9)))) if r < 0.5 else made[i]
        sure = 0.02 if part[-1] == "main" else 0.5
        if rng.random() < sure:  # some blocks of a part speak of what it is; an article may do so too
            cues = _CUES[pick(list(_CUES)) if part[-1] == "main" else part[-1]].split()
            made = [pick(cues) if rng.random() < 0.4 else w for w in made]
        return " ".join(made)

    def sentence(n):
        t = words(n).capitalize()
        return t + pick([".", ".", ".", ".", "!", "?"]) if rng.random() < 0.9 else t

    def emit(text, good):
        truth.append((text, good))
        return text

    def hint(kind, sure=0.8):
        if rng.random() > sure:
            return pick(["", "", f' class="{words(1)}"', ' class="wrap row"', ' class="box inner"'])
        names = [pick(_NOISE[kind].split() if kind != "main" else _MAIN.split()) for _ in range(int(rng.integers(1, 3)))]
        return f' {pick(["class", "class", "id"])}="{pick([" ", "-", "_"]).join(names)}"'

    def long_words():
        return int(min(400, rng.geometric(1 / pick([4, 12, 40, 90]))))

    def paragraph(good):
        if rng.random() < 0.03:  # spam: a word over and over
            return emit(" ".join([words(1).capitalize(), *[words(1)] * int(rng.integers(5, 600))]), good)
        text = emit(" ".join(sentence(int(rng.integers(1, 25))) for _ in range(max(1, long_words() // 12))), good)
        if rng.random() < 0.1 and len(text.split()) > 3:
            a = text.split()
            return " ".join([*a[:1], f'<a href="/{a[1]}">{a[1]}</a>', *a[2:]])
        return text

    def article():
        out = []
        if rng.random() < 0.8:
            h = pick(["h1", "h1", "h1", "h2"])
            out.append(f"<{h}>{emit(sentence(int(rng.integers(1, 12))), True)}</{h}>")
        for _ in range(int(min(60, rng.geometric(1 / pick([1.2, 4, 12]))))):
            r = rng.random()
            if r < 0.66:
                out.append(f"<p>{paragraph(True)}</p>" if rng.random() < 0.8 else f"<p>{paragraph(True)}")
            elif r < 0.73:
                out.append(f"<p><b>{paragraph(True)}<br>")
            elif r < 0.79:
                out.append(f"<{pick(['h2', 'h3', 'h4'])}>{emit(words(int(rng.integers(1, 8))).capitalize(), True)}</h3>".replace("</h3>", "") + "<p>" + paragraph(True) + "</p>")
            elif r < 0.85:
                out.append("<ul>" + "".join(f"<li>{emit(sentence(int(rng.integers(1, 14))), True)}</li>" for _ in range(int(rng.integers(1, 7)))) + "</ul>")
            elif r < 0.88:
                out.append(f"<blockquote>{paragraph(True)}</blockquote>")
            elif r < 0.9:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{emit(words(int(rng.integers(1, 4))), True)}</td>" for _ in range(2)) + "</tr>" for _ in range(int(rng.integers(1, 4)))) + "</table>")
            elif r < 0.91:  # spam: a line over and over
                line = f"<p>{sentence(int(rng.integers(1, 6)))}</p>"
                count = int(rng.integers(5, 60))
                truth.extend([(re.sub("<[^>]*>", "", line), True)] * count)
                out.append(line * count)
            elif r < 0.93:
                out.append(f"<figure><figcaption>{emit(sentence(6), True)}</figcaption></figure>")
            else:
                out.append(noise(pick(["ad", "ad", "share", "notice", "sidebar", "form"])))
        return "".join(out)

    def noise(kind):
        tag = pick(_NOISE_TAGS[kind])
        part.append(kind)
        named = tag in ("nav", "footer", "aside", "header", "form")
        attributes = hint(kind, 0.35 if named else 0.97)
        n = int(rng.integers(1, 9))
        if kind == "nav" or (kind in ("sidebar", "share", "footer", "header") and rng.random() < 0.5):
            items = "".join(f'<li><a href="/{i}">{emit(words(int(rng.integers(1, 4))), False)}</a></li>' for i in range(n))
            inner = items if tag in ("ul", "ol") else f"<ul>{items}</ul>"
            if rng.random() < 0.3:
                inner = f"<h3>{emit(words(2), False)}</h3>" + inner
        elif kind == "comments":
            inner = (f"<h3>{emit(words(1), False)}</h3>" if rng.random() < 0.7 else "") + "".join(f'<div class="{pick(["comment", "reply", "user"])}"><p>{emit(sentence(int(rng.integers(2, 60))), False)}</p></div>' for _ in range(n))
        elif kind == "form":
            inner = f'<label>{emit(words(2), False)}</label><p><input name="q"></p>' + (f"<p>{emit(sentence(8), False)}</p>" if rng.random() < 0.6 else "")
        elif rng.random() < 0.5:
            inner = ("&copy; " if kind == "footer" and rng.random() < 0.5 else "") + emit(sentence(int(rng.integers(1, 30))), False)
        else:
            inner = "".join(f"<p>{emit(sentence(int(rng.integers(2, 40))), False)}</p>" for _ in range(1 + n // 3))
        part.pop()
        return f"<{tag}{attributes}>{inner}</{tag}>"

    top = "".join(noise(k) for k in ("notice", "header", "nav", "ad", "share") if rng.random() < 0.55)
    if rng.random() < 0.35:
        top += noise("sidebar")
    shell = rng.random()
    body_open, body_close = ("<article>", "</article>") if shell < 0.45 else (f"<main{hint('main', 0.4)}>", "</main>") if shell < 0.6 else (f"<div{hint('main', 0.9)}>", "</div>") if shell < 0.9 else (f"<section{hint('main', 0.9)}>", "</section>")
    if rng.random() < 0.3:
        body_open, body_close = f"<div{hint('main', 0.5)}>" + body_open, body_close + "</div>"
    middle = body_open + article()
    if rng.random() < 0.2:
        middle += noise(pick(["share", "comments", "ad", "form"]))
    middle += body_close
    bottom = "".join(noise(k) for k in ("share", "sidebar", "comments", "form", "ad", "notice", "footer") if rng.random() < 0.5)
    title = words(4)
    page = f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{top}{middle}{bottom}</body></html>"
    return page, truth


_TRAINED: dict[tuple, Labeller] = {}


def trained(pages: int = PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """The labeller fitted on `pages` generated pages; once in a process."""
    key = (pages, epochs, seed)
    if key in _TRAINED:
        return _TRAINED[key]
    rng = np.random.default_rng(seed)
    data = []
    while len(data) < pages:
        page, truth = _generated(rng)
        blocks = leaf_blocks(page)
        good = {}
        for t, g in truth:
            good[" ".join(t.split())] = good.get(" ".join(t.split()), True) and g
        if blocks:
            y = np.array([next((v for k, v in ((b.text, good.get(b.text)), (b.text, good.get(b.text.removeprefix("© ")))) if v is not None), False) for b in blocks], np.float32)
            data.append((features([blocks]), y))
    net = Labeller(rng)
    first, second, step = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    total = epochs * ((len(data) + BATCH - 1) // BATCH)
    for _ in range(epochs):
        order = sorted(rng.permutation(len(data)).tolist(), key=lambda i: len(data[i][1]) // 8)
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for k in rng.permutation(len(batches)):
            chosen = [data[i] for i in batches[k]]
            x = np.concatenate([x for x, _ in chosen])
            x[:, PATH : PATH + WORDS] *= rng.random((len(x), 1)) < 0.5  # words of the corpus differ from ours
            x[:, :PATH] *= rng.random((len(x), 1)) < 0.9  # and so do its tags
            g = net.gradients(x, np.array([len(y) for _, y in chosen]), np.concatenate([y for _, y in chosen]))
            step += 1
            rate = 0.01 * (1 - step / (total + 1)) + 1e-4
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            for name, v in g.items():
                v = v * min(1.0, 5 / (norm + 1e-9))
                first[name] += 0.1 * (v - first[name])
                second[name] += 0.001 * (v * v - second[name])
                net.p[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    _TRAINED[key] = net
    return net


def trained_in_task(spark) -> Labeller:
    """trained(), computed in one Spark task: there numpy keeps to one thread, which is quicker for
    matrices this small and gives the same weights everywhere. Kept by the driver."""
    key = (PAGES, EPOCHS, SEED)
    if key not in _TRAINED:
        import pickle

        ship_package(spark)

        def run(batches):
            import pandas as pd

            for _ in batches:
                pass
            yield pd.DataFrame({"net": [pickle.dumps(trained())]})

        _TRAINED[key] = pickle.loads(spark.range(1).coalesce(1).mapInPandas(run, "net binary").first()["net"])
    return _TRAINED[key]


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", extra: tuple[str, ...] = ("url",), net: Labeller | None = None) -> DataFrame:
    """(key, extra columns, text, n_chars, n_blocks, n_kept) of every page. Nothing is shuffled."""
    spark = pages.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(net or trained_in_task(spark))
    source = pages.select(F.col(key).alias("k"), *[F.col(c).alias(f"x{i}") for i, c in enumerate(extra)], F.col(html).alias("html"))
    kept = ["k", *[f"x{i}" for i in range(len(extra))]]

    def run(batches):
        net = shared.value
        for batch in batches:
            for part in slices(batch, "html", 4_000_000):
                blocks = [leaf_blocks(p) for p in part.column("html").to_pylist()]
                marks = net.label(blocks)
                texts = ["\n".join(b.text for b, good in zip(p, m, strict=True) if good) for p, m in zip(blocks, marks, strict=True)]
                made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in blocks], pa.int32()), pa.array([int(m.sum()) for m in marks], pa.int32())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *made], names=[*kept, "text", "n_chars", "n_blocks", "n_kept"])

    schema = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in kept) + ", text string, n_chars long, n_blocks int, n_kept int"
    return source.mapInArrow(run, schema).withColumnsRenamed({"k": key} | {f"x{i}": c for i, c in enumerate(extra)})
