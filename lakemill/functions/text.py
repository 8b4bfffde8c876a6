"""Text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shape of an e-mail address, and the texts read as true.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
TRUE_TEXTS = ("true", "1")
WHITE_SPACE = " \t\n\x0b\f\r"


def strip(c: Column) -> Column:
    """Removes white space of any kind, tabs and newlines included, from both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def title_case(c: Column) -> Column:
    """Capital after every non-letter: `smith-jones` gives `Smith-Jones`.

    `initcap` sees words only at spaces, so where other marks occur, each one before a letter
    gets a space for the moment, set off by a control character.
    """
    parted = F.regexp_replace(c, r"([^\p{L} ])(?=\p{L})", "$1\u0001 ")
    marked = F.replace(F.initcap(parted), F.lit("\u0001 "), F.lit(""))
    return F.when(c.rlike(r"[^\p{L} ]\p{L}"), marked).otherwise(F.initcap(c))


def word_case(c: Column) -> Column:
    """Capital only at the start and after a space: `smith-jones` gives `Smith-jones`."""
    return F.initcap(F.trim(c))


def drop_marks(c: Column, marks: Sequence[str]) -> Column:
    for mark in marks:
        c = F.replace(c, F.lit(mark), F.lit(""))
    return c


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def not_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def is_true_text(c: Column) -> Column:
    return F.coalesce(F.lower(c.cast("string")).isin(*TRUE_TEXTS), F.lit(False))


def is_email(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")).rlike(EMAIL_PATTERN)
