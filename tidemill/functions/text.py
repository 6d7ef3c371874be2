"""Cleaning of text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character of Unicode category Zs (space separators). Tabs and
# line ends are not among them, so they survive a trim.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim(value: str | Column) -> Column:
    """Strip space separators at both ends.

    Spark's one-argument trim knows only U+0020. That is all a text of one-byte characters
    can hold, and it is four times as fast as the trim over a set, so the set is kept for
    texts with longer characters.
    """
    value = as_column(value)
    one_byte = F.length(value) == F.octet_length(value)
    return F.when(one_byte, F.trim(value)).otherwise(F.btrim(value, F.lit(SPACE_SEPARATORS)))


def blank_to_null(value: str | Column) -> Column:
    return F.nullif(trim(value), F.lit(""))


def digits_only(value: str | Column) -> Column:
    return F.regexp_replace(as_column(value), "[^0-9]", "")


def digits_or_null(value: str | Column) -> Column:
    """Digits of a non-blank text. Blank gives NULL; a text without digits gives ''."""
    return F.regexp_replace(blank_to_null(value), "[^0-9]", "")


def parse_date(value: str | Column, pattern: str = "dd/MM/yyyy") -> Column:
    """Date of a text; a text that is no date fails the query (ANSI mode, the default)."""
    return F.to_date(as_column(value), pattern)
