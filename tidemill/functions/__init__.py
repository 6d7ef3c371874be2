"""Column expressions. All are built-in Spark functions, so they stay inside generated code."""

from tidemill.functions.keys import bytes_checksum, surrogate_key, text_checksum
from tidemill.functions.numbers import decimal_comma, size_kb
from tidemill.functions.periods import (
    batch_stamp,
    landing_path,
    next_period,
    normalize_semester,
    partition_of_path,
    period_of,
    previous_period,
    semester_of,
    wall_clock,
)
from tidemill.functions.text import blank_to_null, digits_only, digits_or_null, parse_date, trim

__all__ = [
    "batch_stamp",
    "blank_to_null",
    "bytes_checksum",
    "decimal_comma",
    "digits_only",
    "digits_or_null",
    "landing_path",
    "next_period",
    "normalize_semester",
    "parse_date",
    "partition_of_path",
    "period_of",
    "previous_period",
    "semester_of",
    "size_kb",
    "surrogate_key",
    "text_checksum",
    "trim",
    "wall_clock",
]
