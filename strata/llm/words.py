"""Column expressions over whole texts: words are runs of characters other than ASCII white space."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
GAP = "[ \\t\\n\\x0B\\f\\r]+"


def words(text: Column) -> Column:
    """The words of a text (null and blank texts: none)."""
    body = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(BLANKS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, GAP))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]
