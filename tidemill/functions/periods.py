"""Half-year periods, written ``YYYY-01`` or ``YYYY-02``, and the landing paths built on them."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from tidemill.functions.text import as_column


def normalize_semester(value: str | Column) -> Column:
    """'01' or '02' from '1', '01', '2', '02' or the numbers; anything else fails the query."""
    text = as_column(value).cast("string")
    padded = F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)
    return F.when(padded.isin("01", "02"), padded).otherwise(
        F.raise_error(F.concat(F.lit("semester must be 01 or 02, got "), F.coalesce(text, F.lit("NULL"))))
    )


def semester_of(moment: str | Column) -> Column:
    return F.when(F.month(as_column(moment)) <= 6, "01").otherwise("02")


def _joined(year: Column, semester: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), semester)


def period_of(moment: str | Column) -> Column:
    """Period of a date or timestamp; NULL stays NULL."""
    moment = as_column(moment)
    return F.when(moment.isNotNull(), _joined(F.year(moment), semester_of(moment)))


def _parts(period: str | Column) -> tuple[Column, Column]:
    period = as_column(period)
    return F.split_part(period, F.lit("-"), F.lit(1)).cast("int"), F.split_part(period, F.lit("-"), F.lit(2))


def previous_period(period: str | Column) -> Column:
    """One step back: second half to first, first half to the second of the year before."""
    year, semester = _parts(period)
    return F.when(semester == "02", _joined(year, F.lit("01"))).otherwise(_joined(year - 1, F.lit("02")))


def next_period(period: str | Column) -> Column:
    year, semester = _parts(period)
    return F.when(semester == "01", _joined(year, F.lit("02"))).otherwise(_joined(year + 1, F.lit("01")))


def batch_stamp(moment: str | Column) -> Column:
    return F.date_format(as_column(moment), "yyyy-MM-dd_HHmmss")


def landing_path(source_name: str, file_prefix: str, period: str | Column, stamp: str | Column) -> Column:
    """``<source>/partition=<period>/<prefix>-<period>-<stamp>.csv``"""
    period = as_column(period)
    file_name = F.concat(F.lit(f"{file_prefix}-"), period, F.lit("-"), as_column(stamp), F.lit(".csv"))
    return F.concat_ws("/", F.lit(source_name), F.concat(F.lit("partition="), period), file_name)


def partition_of_path(path: str | Column) -> Column:
    """Value of the ``partition=`` directory in a path, as text; NULL when there is none."""
    return F.nullif(F.regexp_extract(as_column(path), "(?:^|/)partition=([^/]+)/", 1), F.lit(""))


def wall_clock(moment: datetime) -> Column:
    """A zone-less timestamp literal, whatever the zone of the session; a moment with a zone counts in UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return F.lit(moment.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
