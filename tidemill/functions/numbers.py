"""Cleaning of numeric text and file sizes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemill.functions.text import as_column, trim


def decimal_comma(value: str | Column, type_name: str = "decimal(10,2)") -> Column:
    """Number written with a decimal comma; NULL when it is none or does not fit.

    Thousands separators are not removed, so ``1.109,99`` is no number.
    """
    return F.replace(trim(value), F.lit(","), F.lit(".")).try_cast(type_name)


def size_kb(n_bytes: str | Column) -> Column:
    """Bytes as kilobytes with one decimal, halves rounded to even."""
    return F.bround(as_column(n_bytes) / F.lit(1024), 1)
