"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanstream.schemas import STAMP_FORMAT

# The characters a browser script's trim() removes.
TRIM_CHARS = (
    "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def strip_space(text: Column) -> Column:
    """Trim both ends of every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(TRIM_CHARS))


def stamp(moment: Column) -> Column:
    return F.date_format(moment, STAMP_FORMAT)


def parse_stamp(text: Column) -> Column:
    """Inverse of :func:`stamp`, without a zone; text of any other shape gives NULL."""
    shaped = text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def or_default(text: Column, default: str) -> Column:
    return F.coalesce(text, F.lit(default))


def or_else(text: Column, other: Column) -> Column:
    """``other`` where ``text`` is missing or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), other)


def first_element(html: Column, tag: str) -> Column:
    """Markup inside the first ``<tag>`` of a page; empty where there is none."""
    return F.regexp_extract(html, rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)


def all_elements(html: Column, tag: str) -> Column:
    """Markup inside every ``<tag>``; for tags that do not nest in themselves."""
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))


def guard_formula(text: Column) -> Column:
    """Quote a cell that a spreadsheet would otherwise run as a formula."""
    return F.when(text.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)
