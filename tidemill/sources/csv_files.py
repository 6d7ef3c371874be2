"""CSV files of a contract, with the lineage of every row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.contracts import SourceContract
from tidemill.functions import partition_of_path, wall_clock
from tidemill.storage import escape_glob, written_as_they_lie


def file_of_row() -> Column:
    """Plain path of the file a row was read from, as a file listing spells it.

    The metadata column holds the path URL-encoded, except for '+'.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def add_lineage(df: DataFrame, ingestion_ts: datetime | None = None) -> DataFrame:
    """Adds ``source_file`` and ``ingestion_ts`` to rows that come straight from a file source.

    Without a given time every row gets the query's start.
    """
    loaded = F.current_timestamp().cast("timestamp_ntz") if ingestion_ts is None else wall_clock(ingestion_ts)
    return df.select("*", file_of_row().alias("source_file"), loaded.alias("ingestion_ts"))


def scan_csv(spark: SparkSession, contract: SourceContract, paths: str | Sequence[str]) -> DataFrame:
    """Rows of the given files or folders, all columns as text.

    The header of every file must match the contract; a malformed row fails the read.
    Partition directories above a file do not become columns here (see ``scan_landing``).
    A quote inside quotes is doubled and a backslash is a plain sign. Quoted line ends need a
    contract with ``multi_line``, which makes every file one task; without it they fail the read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    options = {
        "sep": ";",
        "escape": '"',
        "multiLine": str(contract.multi_line).lower(),
        **contract.csv_options,
        "header": "true",
        "enforceSchema": "false",
        "mode": "FAILFAST",
        "pathGlobFilter": contract.file_glob,
        "recursiveFileLookup": "true",
    }
    return spark.read.schema(contract.file_schema).options(**options).csv([escape_glob(p) for p in paths])


def scan_landing(
    spark: SparkSession,
    contract: SourceContract,
    paths: str | Sequence[str],
    ingestion_ts: datetime | None = None,
) -> DataFrame:
    """Raw rows: file columns, ``partition`` from the path as text, and the lineage columns."""
    rows = add_lineage(scan_csv(spark, contract, paths), ingestion_ts)
    with_partition = rows.withColumn("partition", partition_of_path("source_file"))
    return with_partition.select(*[F.col(f"`{f.name}`") for f in contract.raw_schema.fields])


def empty_template(spark: SparkSession, contract: SourceContract) -> DataFrame:
    """A table without rows in the shape of the raw table."""
    return spark.createDataFrame([], contract.raw_schema)


def land_csv(raw: DataFrame, contract: SourceContract, landing: str, gathered: bool = False) -> None:
    """Write raw rows as files of the contract, ``<landing>/<source>/partition=<value>/…csv``.

    The rebalance gives every half-year files of a sensible size, however its rows lie. Rows that lie by half-year
    already (``gathered``) are written as they lie.
    """
    columns = [F.col(f"`{c.name}`") for c in contract.columns]
    options = {
        "sep": ";",
        "escape": '"',
        **contract.csv_options,
        "header": "true",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    rows = raw.select(*columns, "partition")
    if not gathered:
        rows = rows.hint("rebalance", F.col("partition"))
    with written_as_they_lie(raw.sparkSession):
        rows.write.partitionBy("partition").options(**options).csv(f"{landing}/{contract.name}")
