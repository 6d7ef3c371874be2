"""The ledger of loaded files: which content is known, and what may not be recorded twice."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from tidemill.functions.periods import wall_clock
from tidemill.operators.quality import duplicate_groups

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType(), False),
        T.StructField("ingestion_ts", T.TimestampNTZType(), True),
        T.StructField("rows_ingested", T.LongType(), False),
        T.StructField("file_checksum", T.StringType(), False),
        T.StructField("load_status", T.StringType(), True),
    ]
)
REQUIRED = ("source_file", "rows_ingested", "file_checksum")
LOADED = "loaded"


def skip_known(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content the ledger does not hold, whatever their name."""
    return files.join(ledger.select("file_checksum"), "file_checksum", "left_anti")


def only_known(files: DataFrame, ledger: DataFrame) -> DataFrame:
    return files.join(ledger.select("file_checksum"), "file_checksum", "left_semi")


def first_of_each_content(files: DataFrame) -> DataFrame:
    """One file per checksum, the first by name; byte-equal twins count as known.

    A plain minimum, so copies are folded together before the shuffle.
    """
    others = [c for c in files.columns if c not in ("file_checksum", "source_file")]
    first = F.min(F.struct("source_file", *others)).alias("first")
    firsts = files.groupBy("file_checksum").agg(first)
    return firsts.select("first.source_file", *[f"first.{c}" for c in others], "file_checksum")


def name_conflicts(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """New files under a name the ledger has already recorded with other content."""
    return files.join(ledger.select("source_file"), "source_file", "left_semi")


def rows_per_file(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Files with their number of loaded rows; a file without rows counts 0."""
    counts = rows.groupBy("source_file").agg(F.count("*").alias("rows_ingested"))
    return files.join(counts, "source_file", "left").withColumn(
        "rows_ingested", F.coalesce("rows_ingested", F.lit(0))
    )


def ledger_entries(files: DataFrame, ingestion_ts: datetime) -> DataFrame:
    """Ledger rows for files that carry ``source_file``, ``rows_ingested`` and ``file_checksum``."""
    return files.select(
        "source_file",
        wall_clock(ingestion_ts).alias("ingestion_ts"),
        F.col("rows_ingested").cast("long").alias("rows_ingested"),
        "file_checksum",
        F.lit(LOADED).alias("load_status"),
    )


def loads_with_rows(ledger: DataFrame) -> DataFrame:
    """Entries of files that brought rows: their newest time is the newest load time of the raw table."""
    return ledger.where("rows_ingested > 0")


def duplicate_names(ledger: DataFrame) -> DataFrame:
    return duplicate_groups(ledger, "source_file")


def duplicate_checksums(ledger: DataFrame) -> DataFrame:
    return duplicate_groups(ledger, "file_checksum")


def missing_required(ledger: DataFrame) -> DataFrame:
    """Number of NULLs per column that must be filled."""
    counts = ledger.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED])
    return counts.unpivot([], list(REQUIRED), "column_name", "failing_rows")
