"""Cleaning of text, place and time columns."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\x0b\f\r\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a\u2028\u2029\u205f\u3000"

LINE_END_BLANKS = " \t\n\x0b\f\r\u0085\u2028\u2029"

# --- Fixed values: cleaning patterns ---
TRAILING_ELLIPSIS = r"\.\.\.\s*$"
TAG = r"<[^>]*>"
LINE_BREAKS = r"[\n\r\t\xa0]"
POSTCODE_OR_HYPHEN = r"\(?[0-9]{2,5}\)?|-"
LONG_DASHES = "\u2013\u2014\u2015"


def moment(value: str | datetime) -> Column:
    """A constant timestamp; text without an offset is in the session zone."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.to_timestamp(F.lit(text))


def replace_entities(text: Column) -> Column:
    return F.when(text.contains("&nbsp;"), F.replace(text, F.lit("&nbsp;"), F.lit(" "))).otherwise(text)


def strip_ellipsis(text: Column, source: Column, sources) -> Column:
    """Drop the dots some sources leave where they cut a text short.

    A text ending in neither dots nor a blank, as most do, is not searched.
    """
    cut_short = reduce(or_, [text.endswith(end) for end in ("...", *LINE_END_BLANKS)])
    stripped = F.regexp_replace(text, TRAILING_ELLIPSIS, "")
    return F.when(source.isin(*sources) & cut_short, stripped).otherwise(text)


def parse_published(text: Column, default: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(text), default)


def strip_tags(text: Column) -> Column:
    """Each tag becomes a space; line breaks, tabs and NBSP become spaces."""
    without_tags = F.when(text.contains("<"), F.regexp_replace(text, TAG, " ")).otherwise(text)
    return F.regexp_replace(without_tags, LINE_BREAKS, " ")


def search_text(title: Column, lowered_description: Column) -> Column:
    return F.concat_ws(" ", F.lower(title), lowered_description)


def clean_location(location: Column) -> Column:
    """Drop postcodes and every hyphen, also one inside a name."""
    return F.trim(F.regexp_replace(location, POSTCODE_OR_HYPHEN, ""))


def fold_dashes(text: Column) -> Column:
    return F.translate(text, LONG_DASHES, "---")


def trim_whitespace(text: Column) -> Column:
    """Trim all Unicode blanks, not only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def slug(text: Column) -> Column:
    return F.lower(F.replace(text, F.lit(" "), F.lit("_")))
