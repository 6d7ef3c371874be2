"""Data-quality assertions: each check names the rows that break it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.periods import wall_clock


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    values: tuple[str, ...] = ()
    pattern: str = ""
    length: int = 0
    low: float | None = None
    high: float | None = None

    def failing(self) -> Column:
        """Predicate that is true on a failing row. NULL passes all kinds but not_null."""
        col = F.col(f"`{self.column}`")
        if self.kind == "not_null":
            return col.isNull()
        if self.kind == "accepted_values":
            return ~col.isin(*self.values)
        if self.kind == "match_regex":
            return ~col.rlike(_to_end_of_text(self.pattern))
        if self.kind == "length_equals":
            return F.length(col) != self.length
        if self.kind == "between":
            bounds = [col < self.low] if self.low is not None else []
            bounds += [col > self.high] if self.high is not None else []
            return reduce(lambda a, b: a | b, bounds)
        raise ValueError(f"{self.kind} is not a per-row check")


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def accepted_values(column: str, values: Sequence[str]) -> Check:
    return Check("accepted_values", column, values=tuple(values))


def match_regex(column: str, pattern: str) -> Check:
    return Check("match_regex", column, pattern=pattern)


def length_equals(column: str, length: int) -> Check:
    return Check("length_equals", column, length=length)


def between(column: str, low: float | None = None, high: float | None = None) -> Check:
    if low is None and high is None:
        raise ValueError("between needs a bound")
    return Check("between", column, low=low, high=high)


def _to_end_of_text(pattern: str) -> str:
    """``$`` in Java also matches before a last line end; ``\\z`` does not."""
    return pattern[:-1] + r"\z" if pattern.endswith("$") and not pattern.endswith(r"\$") else pattern


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """What a check reports: failing rows; for unique and accepted_values, one row per value."""
    if check.kind == "unique":
        return duplicate_groups(df, check.column)
    rows = df.where(check.failing())
    if check.kind == "accepted_values":
        return rows.groupBy(F.col(f"`{check.column}`").alias("value")).agg(F.count("*").alias("n_rows"))
    return rows


def failing_pairs(df: DataFrame, checks: Sequence[Check], *carried: str) -> DataFrame:
    """``column_name, value`` and the carried columns of every failing row of per-row checks, from one scan.

    Rows without a failure are dropped before the checks' pairs are split up.
    """
    failing = [F.coalesce(c.failing(), F.lit(False)) for c in checks]
    pairs = F.array(
        *[
            F.when(f, F.struct(F.lit(c.column).alias("column_name"), F.col(f"`{c.column}`").alias("value")))
            for c, f in zip(checks, failing, strict=True)
        ]
    )
    rows = df.where(reduce(lambda a, b: a | b, failing)).withColumn("failed", F.explode(F.array_compact(pairs)))
    return rows.select("failed.column_name", "failed.value", *carried)


def duplicate_groups(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, with their row counts; NULLs are left out."""
    value = F.col(f"`{column}`")
    counted = df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n_rows"))
    return counted.where("n_rows > 1")


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One line per check: failures as the check counts them, failing rows, status.

    Row checks share one scan with one small aggregate. Value checks look only at the
    rejected values, all columns in one pass. Each unique check groups its own column.
    """
    parts = []
    row_checks = [c for c in checks if c.kind not in ("unique", "accepted_values")]
    if row_checks:
        parts.append(_count_rows(df, row_checks))
    value_checks = [c for c in checks if c.kind == "accepted_values"]
    if value_checks:
        parts.append(_count_values(df, value_checks))
    parts += [_count_duplicates(df, c) for c in checks if c.kind == "unique"]
    if not parts:
        raise ValueError("no checks given")
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def _lines(counts: Sequence[tuple[Check, Column, Column]]) -> Column:
    """Turns the one row of an aggregate into one report line per check."""
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(check.column).alias("column_name"),
                    F.lit(check.kind).alias("check_name"),
                    failures.alias("failures"),
                    rows.alias("failing_rows"),
                )
                for check, failures, rows in counts
            ]
        )
    )


def _count_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counts = df.agg(*[F.count_if(c.failing()).alias(f"c{i}") for i, c in enumerate(checks)])
    return counts.select(_lines([(c, F.col(f"c{i}"), F.col(f"c{i}")) for i, c in enumerate(checks)]))


def _count_values(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rejected values per check. Rows without any are dropped before the values are split up."""
    any_bad = reduce(lambda a, b: a | b, [F.coalesce(c.failing(), F.lit(False)) for c in checks])
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("check_no"), F.when(c.failing(), F.col(f"`{c.column}`")).alias("value"))
            for i, c in enumerate(checks)
        ]
    )
    rejected = df.where(any_bad).select(F.inline(pairs)).where("value is not null")
    per_value = rejected.groupBy("check_no", "value").agg(F.count("*").alias("n_rows"))
    sums = []
    for i in range(len(checks)):
        mine = F.col("check_no") == i
        sums += [F.count_if(mine).alias(f"f{i}"), F.sum(F.when(mine, F.col("n_rows")).otherwise(0)).alias(f"r{i}")]
    return per_value.agg(*sums).select(
        _lines([(c, F.col(f"f{i}"), F.coalesce(f"r{i}", F.lit(0))) for i, c in enumerate(checks)])
    )


def _count_duplicates(df: DataFrame, check: Check) -> DataFrame:
    groups = duplicate_groups(df, check.column)
    return groups.agg(
        F.count("*").alias("failures"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failing_rows")
    ).select(F.lit(check.column).alias("column_name"), F.lit("unique").alias("check_name"), "failures", "failing_rows")


def freshness(
    df: DataFrame, loaded_at: str, as_of: Sequence[datetime], warn_after_days: int, error_after_days: int
) -> DataFrame:
    """Age of the newest row at each moment, and pass, warn or error. No rows is an error."""
    newest = df.agg(F.max(loaded_at).alias("newest"))
    moments = F.explode(F.array(*[wall_clock(m) for m in as_of])).alias("as_of")
    aged = newest.select("newest", moments).withColumn("age", F.col("as_of") - F.col("newest"))
    day = F.make_dt_interval(F.lit(1))
    status = (
        F.when(F.col("age").isNull() | (F.col("age") > day * error_after_days), "error")
        .when(F.col("age") > day * warn_after_days, "warn")
        .otherwise("pass")
    )
    return aged.select("as_of", "newest", status.alias("status"))
