"""URL columns, native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_url(url: Column) -> Column:
    """The URL without its fragment."""
    return F.substring_index(url, "#", 1)


def _until(text: Column, ends: str) -> Column:
    """text up to the first of the characters `ends`, a class of a regular expression."""
    return F.split(text, f"[{ends}]", 2)[0]


def _parts(url: Column) -> tuple[Column, Column, Column]:
    """(what stands before `://`, what stands after it, whether the former is http or https)."""
    head = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1)).when(url.isNotNull(), "")
    after = F.when(head != "", F.substr(url, F.length(head) + 4)).when(url.isNotNull(), "")
    return head, after, F.lower(head).isin("http", "https")


def _where(condition: Column, value: Column) -> Column:
    """value, empty where the condition fails, null where it is unknown."""
    return F.when(condition, value).when(~condition, "")


def scheme(url: Column) -> Column:
    head, _, web = _parts(url)
    return _where(web & (head == F.lower(head)), head)


def domain(url: Column) -> Column:
    """The host without its port."""
    _, after, web = _parts(url)
    return _where(web, F.lower(_until(after, "/:?#")))


def authority(url: Column) -> Column:
    """Host with port, as written between the slashes."""
    head, after, web = _parts(url)
    return _where(web & (head == F.lower(head)), F.lower(_until(after, "/?#")))


def path(url: Column) -> Column:
    """From the first slash after the host up to query or fragment; empty without a host."""
    _, after, web = _parts(url)
    whole = _until(after, "?#")
    slash = F.instr(whole, "/")
    return _where(web, F.when(slash > 1, F.substr(whole, slash)).otherwise(""))


def extension(url: Column) -> Column:
    """Letters and digits after the last dot, if nothing else follows it before query and fragment."""
    whole = _until(url, "?#")
    last = F.substring_index(whole, ".", -1)
    return _where(F.contains(whole, F.lit(".")) & (last != "") & (F.regexp_replace(last, "[a-zA-Z0-9]", "") == ""), F.lower(last))


def is_valid(url: Column) -> Column:
    """Whether it is http or https with something that can be a host."""
    _, after, web = _parts(url)
    return web & (_until(after, r"/?#\s") != "")


def strict_host(url: Column) -> Column:
    """The host of an http(s) URL that has one and carries no credentials; else null."""
    fits = url.rlike(r"(?i)^https?://[^/?#\s@]+(?:[/?#]|$)")
    return F.when(fits, F.lower(F.regexp_extract(url, r"(?i)^https?://([^/:?#\s]+)", 1)))


def fetch_url(url: Column) -> Column:
    """What is fetched for a URL: trimmed, without its fragment."""
    return F.split_part(F.trim(url), F.lit("#"), F.lit(1))


def redirected_home(requested: Column, final: Column) -> Column:
    """Whether a request for a page below the root ended at the root."""
    root = lambda u: F.rtrim(path(u), F.lit("/")) == ""
    bare = F.regexp_extract(final, r"^[^?#]*\?([^#]*)", 1) == ""
    return ~root(requested) & root(final) & bare
