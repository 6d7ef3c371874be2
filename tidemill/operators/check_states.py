"""Check results per slice of a keyed table, kept beside it and folded into the report.

All checks of a slice come down to a few rows: sums per check, and rejected values with their counts. A slice never
changes, so its rows are made once; after an upsert only the slices it rewrote are read. The rows of
all current slices are written as one small table per run, which replaces the one before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.operators.keyed_table import KeyedTable
from tidemill.operators.quality import Check, run_checks
from tidemill.storage import delete_dir, glob_paths

STATE = "version string, slice string, check_no int, value string, failures bigint, failing_rows bigint"
#: Stands for a slice that was looked at, whatever the checks found: its number of rows.
SEEN = -1


def foldable(table: KeyedTable, checks: Sequence[Check]) -> bool:
    """Whether the results of slices add up: a key lies in one slice, other columns may repeat across them."""
    return all(c.kind != "unique" or c.column == table.key for c in checks)


def run_stored_checks(spark: SparkSession, table: KeyedTable, checks: Sequence[Check]) -> DataFrame:
    """The report of ``run_checks`` over the stored table, from states; slices without one are read.

    With deltas pending, or a unique check on another column than the key, the whole table is read.
    """
    if not foldable(table, checks) or table.deltas(spark):
        return run_checks(table.read(spark), checks)
    return _folded(refresh_states(spark, table, checks), checks)


def refresh_states(spark: SparkSession, table: KeyedTable, checks: Sequence[Check]) -> DataFrame:
    """The states of all current slices, stored; made for those that have none."""
    folder = f"{table.root}/_checks/{hashlib.sha256(repr(tuple(checks)).encode()).hexdigest()[:16]}"
    runs = sorted(int(p.rsplit("/", 2)[1].removeprefix("run=")) for p in glob_paths(spark, f"{folder}/run=*/_SUCCESS"))
    current = [(path.rsplit("/", 2)[1], name) for name, path in table.slices(spark).items()]
    held = spark.read.schema(STATE).parquet(f"{folder}/run={runs[-1]}") if runs else spark.createDataFrame([], STATE)
    known = {(r["version"], r["slice"]) for r in held.where(F.col("check_no") == SEEN).select("version", "slice").collect()}
    missing = [unit for unit in current if unit not in known]
    if runs and not missing and len(known) == len(current):
        return held
    units = spark.createDataFrame(current, "version string, slice string")
    kept = held.join(units, ["version", "slice"], "left_semi")
    made = [_states(rows, table, checks) for rows in table.read_units(spark, missing)]
    run = (runs[-1] if runs else 0) + 1
    reduce(DataFrame.unionByName, made, kept).coalesce(1).write.mode("overwrite").parquet(f"{folder}/run={run}")
    for old in runs:
        delete_dir(spark, f"{folder}/run={old}")
    return spark.read.schema(STATE).parquet(f"{folder}/run={run}")


def _states(rows: DataFrame, table: KeyedTable, checks: Sequence[Check]) -> DataFrame:
    """States of the slices of ``rows``: one aggregate for all row checks, rejected values, and the key's repeats."""
    by = ["version", "slice"]
    plain = [(i, c) for i, c in enumerate(checks) if c.kind not in ("unique", "accepted_values")]
    counted = rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(c.failing()).alias(f"c{i}") for i, c in plain])
    lines = [_line(SEEN, F.col("n"))] + [_line(i, F.col(f"c{i}")) for i, _ in plain]
    parts = [counted.select(*by, F.inline(F.array(*lines)))]
    listed = [(i, c) for i, c in enumerate(checks) if c.kind == "accepted_values"]
    if listed:
        rejected = [F.coalesce(c.failing(), F.lit(False)) for _, c in listed]
        pairs = [
            F.when(f, F.struct(F.lit(i).alias("check_no"), F.col(f"`{c.column}`").cast("string").alias("value")))
            for (i, c), f in zip(listed, rejected, strict=True)
        ]
        values = rows.where(reduce(lambda a, b: a | b, rejected)).select(*by, F.inline(F.array_compact(F.array(*pairs))))
        parts.append(
            values.groupBy(*by, "check_no", "value").agg(F.lit(1).cast("long").alias("failures"), F.count("*").alias("failing_rows"))
        )
    for i, c in enumerate(checks):
        if c.kind == "unique":
            column = F.col(f"`{c.column}`")
            repeats = rows.where(column.isNotNull()).groupBy(*by, column).agg(F.count("*").alias("n")).where("n > 1")
            sums = repeats.groupBy(*by).agg(F.count("*").alias("failures"), F.sum("n").alias("failing_rows"))
            parts.append(sums.select(*by, F.lit(i).alias("check_no"), F.lit(None).cast("string").alias("value"), "failures", "failing_rows"))
    return reduce(DataFrame.unionByName, parts)


def _line(check_no: int, n: Column) -> Column:
    return F.struct(
        F.lit(check_no).alias("check_no"), F.lit(None).cast("string").alias("value"), n.alias("failures"), n.alias("failing_rows")
    )


def _folded(states: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One line per check; a value that several slices reject is one failure."""
    spark = states.sparkSession
    names = spark.createDataFrame(
        [(i, c.column, c.kind) for i, c in enumerate(checks)], "check_no int, column_name string, check_name string"
    )
    once = states.groupBy("check_no", "value").agg(F.sum("failures").alias("failures"), F.sum("failing_rows").alias("failing_rows"))
    failures = F.sum(F.when(F.col("value").isNull(), F.col("failures")).otherwise(1))
    sums = once.groupBy("check_no").agg(failures.alias("failures"), F.sum("failing_rows").alias("failing_rows"))
    report = names.join(sums, "check_no", "left").select(
        "column_name", "check_name", F.coalesce("failures", F.lit(0)).alias("failures"), F.coalesce("failing_rows", F.lit(0)).alias("failing_rows")
    )
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
