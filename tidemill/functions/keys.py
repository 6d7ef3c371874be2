"""Row keys and content checksums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemill.functions.text import as_column

# The text that stands for NULL in a key, and the joint between parts.
NULL_PART = "_dbt_utils_surrogate_key_null_"
PART_JOINT = "-"


def surrogate_key(*parts: str | Column) -> Column:
    """MD5 over the joined text of all parts. NULL parts count, unlike in ``concat_ws``."""
    texts = [F.coalesce(as_column(p).cast("string"), F.lit(NULL_PART)) for p in parts]
    return F.md5(F.concat_ws(PART_JOINT, *texts))


def bytes_checksum(content: str | Column) -> Column:
    return F.sha2(as_column(content), 256)


def text_checksum(text: str | Column) -> Column:
    """SHA-256 of the UTF-8 bytes of a text."""
    return F.sha2(as_column(text).cast("binary"), 256)
