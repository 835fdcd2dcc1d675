"""Pattern tests that stay inside generated code and skip needless work.

A regular expression decodes the whole text to characters each time it runs; a
substring test compares bytes. On long texts the substring test costs a small
fraction of the pattern, so it runs first wherever a match implies a substring.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def letters_bounded(pattern: str) -> str:
    """Make each word boundary treat accented letters as letters.

    Newer Java versions read a bare boundary as ASCII only. The flag is scoped
    to the boundary, so other classes in the pattern keep their meaning.
    """
    return pattern.replace(r"\b", r"(?U:\b)")


def contains_any(text: Column, phrases) -> Column:
    """True where ``text`` holds one of the literal ``phrases``.

    Short phrases are the likelier hits, so they are tried first.
    """
    return reduce(or_, [text.contains(p) for p in sorted(phrases, key=len)])


def matches(text: Column, pattern: str, needles=()) -> Column:
    """True where ``pattern`` is found; ``needles`` as in :class:`Skill`."""
    found = text.rlike(letters_bounded(pattern))
    return contains_any(text, needles) & found if needles else found


def first_number(text: Column, pattern: str) -> Column:
    """First group of the first match as text; NULL instead of an empty match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
