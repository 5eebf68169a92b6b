"""Text columns: native where Spark can say it, vectorised Python where Unicode needs it."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed pattern: words of letters and digits, or runs of CJK ideographs.
WORDS = "[\\x{3400}-\\x{9fff}]+|(?:(?![\\x{3400}-\\x{9fff}])[\\p{L}\\p{N}])+"
CJK = "^[\\x{3400}-\\x{9fff}]"
#: Fixed: titles of error pages, and texts that hold a long run of encoded bytes.
ERROR_TITLE = r"(?i)^(?:just a moment|access denied|attention required|robot check|403(?:\s+forbidden)?|404(?:\s+(?:not found|error))?|page not found|sign in to continue|enable javascript)(?:\b|$)"
ENCODED_RUN = "[A-Za-z0-9+/]{180,}={0,2}"


def fold(text: Column) -> Column:
    """Case folding for the letters whose folding differs from lower case in practice."""
    return F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def words(text: Column) -> Column:
    """Case-folded words; a run of CJK ideographs stays one piece."""
    return F.regexp_extract_all(fold(text), F.lit(WORDS), F.lit(0))


def lexical_tokens(text: Column) -> Column:
    """Words, and for each CJK run its characters followed by its adjacent pairs."""
    chars = lambda p: F.filter(F.split(p, ""), lambda c: c != "")
    pairs = lambda p: F.when(F.length(p) > 1, F.transform(F.sequence(F.lit(1), F.length(p) - 1), lambda i: F.substring(p, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(words(text), lambda p: F.when(p.rlike(CJK), F.concat(chars(p), pairs(p))).otherwise(F.array(p))))


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def retrieval_text(text: Column) -> Column:
    """Composed (NFC), runs of any white space as one space, trimmed."""
    return F.trim(F.regexp_replace(nfc(text), r"(?U)\s+", " "))


#: Fixed: quotes and dashes that scoring treats as one.
_PLAIN = str.maketrans({"“": '"', "”": '"', "‘": "'", "’": "'", "–": "-", "—": "-", "−": "-"})


def scoring_form(text: str) -> str:
    """Entities decoded, compatibility-composed, case-folded, quotes and dashes plain, spaces single."""
    return " ".join(unicodedata.normalize("NFKC", html.unescape(text)).casefold().translate(_PLAIN).split())


@F.pandas_udf(StringType())
def scoring_text(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else scoring_form(t))


def query_key(text: Column) -> Column:
    return F.concat_ws(" ", words(text))


# The length of the run and its counts of classes.
def has_encoded_payload(text: Column) -> Column:
    """Whether the text holds a base64-like run of 180 characters with mixed classes."""
    without = lambda v, p: F.length(v) - F.length(F.regexp_replace(v, p, ""))
    mixed = lambda v: (without(v, "[a-z]") >= 6) & (without(v, "[A-Z]") >= 6) & (without(v, "[0-9]") >= 4) & (F.size(F.array_distinct(F.split(F.rtrim(v, F.lit("=")), ""))) >= 30)
    return F.exists(F.regexp_extract_all(text, F.lit(ENCODED_RUN), F.lit(0)), mixed)


# The codes.
def error_page_reason(title: Column, text: Column) -> Column:
    """A code if the title, or the first line where it is blank, is that of an error page."""
    head = F.when(F.trim(title) != "", F.trim(title)).otherwise(F.split_part(F.trim(text), F.lit("\n"), F.lit(1)))
    low = F.lower(head)
    has = lambda *xs: F.greatest(*[low.contains(x) for x in xs]) if len(xs) > 1 else low.contains(xs[0])
    code = F.when(has("javascript"), "JS_REQUIRED").when(has("sign in"), "LOGIN_REQUIRED").when(has("404", "not found"), "NOT_FOUND_PAGE").when(has("access denied", "403"), "ACCESS_DENIED_PAGE").otherwise("BOT_CHALLENGE")
    return F.when(head.rlike(ERROR_TITLE), code)


# The codes and the length of a code.
def reason_code(reason: Column) -> Column:
    """A failure's reason as a short code of capitals and underscores."""
    value = F.when(reason.startswith("ValueError:"), F.substr(reason, F.lit(12))).otherwise(reason)
    last = F.upper(F.element_at(F.split(value, ":"), -1))
    plain = F.left(F.trim(F.regexp_replace(F.upper(value), "[^A-Z0-9]+", "_"), F.lit("_")), F.lit(100))
    return (
        F.when(value.contains("empty_extracted_text_or_scanned_pdf"), "EMPTY_CONTENT_OR_SCAN_PDF")
        .when(value.contains("blocked_or_challenge_page"), F.when(value.contains(":"), last).otherwise("BOT_CHALLENGE"))
        .otherwise(plain)
    )


# Names of flags and tiers, and the thresholds.
def quality(text: Column, title: Column, sections: Column, raw_bytes: Column) -> Column:
    """A struct of counters, flags and tier; it describes a document and never filters it."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    repeats = (F.size(lines) - F.size(F.array_distinct(lines))) / F.greatest(F.lit(1), F.size(lines))
    dense = F.regexp_replace(text, r"\s", "")
    letters = F.length(F.regexp_replace(dense, r"[^\p{L}]", "")) / F.greatest(F.lit(1), F.length(dense))
    paragraphs = F.size(F.filter(F.split(text, r"\n\s*\n"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")) != ""))
    payload = has_encoded_payload(text)
    checks = [
        ("TOO_SHORT", F.length(F.trim(text)) < 80),
        ("MISSING_TITLE", F.trim(title) == ""),
        ("NO_SECTIONS", sections == 0),
        ("ONE_GIANT_PARAGRAPH", (F.length(text) > 2000) & (paragraphs <= 1)),
        ("HIGH_DUPLICATE_LINE_RATIO", repeats > 0.3),
        ("LOW_ALPHABETIC_RATIO", letters < 0.3),
        ("ENCODED_PAYLOAD_SUSPECTED", payload),
        ("DECODE_REPLACEMENT_CHAR", text.contains("�")),
        ("POSSIBLE_TRUNCATION", (raw_bytes > 100_000) & (F.length(text) < 200)),
    ]
    flags = F.array_compact(F.array(*[F.when(c, n) for n, c in checks]))
    low = F.arrays_overlap(flags, F.array(*[F.lit(x) for x in ("TOO_SHORT", "HIGH_DUPLICATE_LINE_RATIO", "LOW_ALPHABETIC_RATIO", "ENCODED_PAYLOAD_SUSPECTED")]))
    tier = F.when(low, "LOW").when((F.length(text) >= 300) & ~text.contains("�"), "HIGH").otherwise("MEDIUM")
    return F.struct(F.length(text).alias("char_count"), paragraphs.alias("paragraph_count"), letters.alias("alphabetic_ratio"), repeats.alias("duplicate_line_ratio"), flags.alias("quality_flags"), tier.alias("quality_tier"))


# The least length and the shares of script characters.
def language_hint(text: Column, declared: Column) -> Column:
    """A struct (language, method): short texts and texts without a script's mark trust what was
    declared; a fifth of Han characters means zh, a hundredth of Vietnamese marks vi."""
    n = F.greatest(F.lit(1), F.length(F.regexp_replace(text, r"\s", "")))
    han = (F.length(text) - F.length(F.regexp_replace(text, "[\\x{3400}-\\x{9fff}]", ""))) / n
    marks = (F.length(text) - F.length(F.regexp_replace(text, "[ăâđêôơưĂÂĐÊÔƠƯ\\x{1ea0}-\\x{1ef9}]", ""))) / n
    fallback = F.when(declared != "", declared).otherwise("unknown")
    named = lambda lang, how: F.struct(lang.alias("language"), F.lit(how).alias("method"))
    return F.when(F.length(F.trim(text)) < 80, named(fallback, "declared")).when(han >= 0.2, named(F.lit("zh"), "script")).when(marks >= 0.01, named(F.lit("vi"), "marks")).otherwise(named(fallback, "declared"))
