"""Keys out of URLs, header names, best-of texts and page markers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchloom.functions.cells import captured, found

# Where the ids sit in the known URL shapes.
MATCH_KEY = r"/matches/(\d+)"
MAP_KEY = r"/mapstatsid/(\d+)"
PATH_KEY = r"/(\d+)/"
FIRST_NUMBER = r"(\d+)"

# Texts that mark a page as blocked or challenged.
MARKERS = [
    "access denied", "captcha", "checking your browser", "cloudflare",
    "enable javascript", "just a moment", "verify you are human",
]
SNIPPET_LIMIT = 300


def key_from_url(url: Column, pattern: str) -> Column:
    """Numeric key, or null when the URL does not hold one."""
    return captured(url, pattern)


def text_key_from_url(url: Column) -> Column:
    """First digits of the URL, or the URL itself."""
    return F.coalesce(found(url, FIRST_NUMBER), url)


def header_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[^a-z0-9.]", "")


# The characters that count as white space.
BLANKS = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
          "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def best_of(text: Column) -> Column:
    """``bo3``, ``bo5`` or ``bo1`` from the first line; null when none applies."""
    line = strip(F.split(F.upper(strip(text)), "\n")[0])
    return (F.when(line.contains("3"), "bo3").when(line.contains("5"), "bo5")
             .when(line.contains("1"), "bo1"))


def is_forfeit(map_name: Column) -> Column:
    return F.lower(strip(map_name)) == F.lit("default")


def markers_in(html: Column) -> Column:
    """Names of the markers a page contains."""
    low = F.lower(F.coalesce(html, F.lit("")))
    hits = [F.when(low.contains(m), F.lit(m.replace(" ", "_"))) for m in MARKERS]
    return F.array_compact(F.array(*hits))


def snippet(html: Column, limit: int = SNIPPET_LIMIT) -> Column:
    collapsed = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?U)\s+", " ")
    return F.substring(F.trim(collapsed), 1, limit)


def holds_element(html: Column, tag: str, css_class: str) -> Column:
    """True when the page has a ``tag`` whose class list names ``css_class``."""
    pattern = rf'(?is)<{tag}\b[^>]*\bclass\s*=\s*["\'](?:[^"\']*\s)?{css_class}(?:\s[^"\']*)?["\']'
    return F.coalesce(html, F.lit("")).rlike(pattern)
