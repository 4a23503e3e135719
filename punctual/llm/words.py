"""Word counting and splitting with built-in expressions. A word is a run of characters other than ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that separates words, and a word, as Java patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of ``text`` in order; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def matches(text: Column, pattern: str) -> Column:
    """How many matches of ``pattern`` are in ``text`` (long; 0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def word_count(text: Column) -> Column:
    return matches(text, WORD)
