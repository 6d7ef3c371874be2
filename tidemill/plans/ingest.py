"""Batch ingestion: every file content once, the ledger last."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import islice

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from tidemill.contracts import SourceContract
from tidemill.operators.ledger import (
    LEDGER_SCHEMA,
    REQUIRED,
    first_of_each_content,
    ledger_entries,
    name_conflicts,
    rows_per_file,
    skip_known,
)
from tidemill.plans.archive import archive_files, check_archive
from tidemill.plans.warehouse import Warehouse
from tidemill.sources.csv_files import scan_landing
from tidemill.sources.file_units import checksum_files, list_files
from tidemill.storage import Lease, exclusive, path_exists, written_as_they_lie

log = logging.getLogger(__name__)

PENDING_SCHEMA = "source_file string, size_bytes bigint, file_checksum string"


@dataclass(frozen=True)
class IngestResult:
    batches: tuple[int, ...]
    files_loaded: int


def ingest(
    spark: SparkSession,
    source: SourceContract,
    incoming: str,
    warehouse: Warehouse,
    ingestion_ts: datetime | None = None,
    archive_root: str | None = None,
    files_per_batch: int = 10_000,
) -> IngestResult:
    """Load every file below ``incoming`` whose content is not in the ledger.

    A folder without files is an error, as is a known name with new content; the latter
    is found before any row is loaded. Files go in batches of ``files_per_batch``, each
    committed by its ledger entry, so a failure loses at most the running batch. The
    driver holds the listing of the landing folder and the names of one batch.
    """
    if not path_exists(spark, incoming):
        raise FileNotFoundError(f"no folder {incoming}")
    found = list_files(spark, incoming, source.file_glob)
    if found.isEmpty():
        raise FileNotFoundError(f"no {source.file_glob} files in {incoming}")
    if archive_root:
        check_archive(incoming, archive_root)
    result = load_files(spark, source, [incoming], warehouse, ingestion_ts, files_per_batch)
    if archive_root:
        archive_files(found, incoming, archive_root)
    return result


def load_files(
    spark: SparkSession,
    source: SourceContract,
    paths: Sequence[str],
    warehouse: Warehouse,
    ingestion_ts: datetime | None = None,
    files_per_batch: int = 10_000,
) -> IngestResult:
    """The loading part of ``ingest`` for given files or folders; a second writer at the same time fails."""
    with exclusive(spark, warehouse.lease_path(source.name)) as lease:
        return _load_files(spark, source, paths, warehouse, ingestion_ts or datetime.now(timezone.utc), files_per_batch, lease)


def _load_files(
    spark: SparkSession,
    source: SourceContract,
    paths: Sequence[str],
    warehouse: Warehouse,
    ingestion_ts: datetime,
    files_per_batch: int,
    lease: Lease,
) -> IngestResult:
    ledger = warehouse.read_ledger(spark, source)
    pending = _write_pending(spark, source, paths, warehouse, ledger)

    batches, n_files = [], 0
    for batch in _batches(pending, ledger, files_per_batch):
        batches.append(_load_batch(spark, source, batch, pending, warehouse, ingestion_ts, lease))
        n_files += len(batch)
        log.info("committed batch %d with %d files", batches[-1], len(batch))
    return IngestResult(tuple(batches), n_files)


def _batches(pending: DataFrame, ledger: DataFrame, size: int) -> Iterator[list[str]]:
    """Names of new files, ``size`` at a time, after a look at all of them for names that the ledger has.

    One pass finds both when they are no more than a batch.
    """
    recorded = ledger.select("source_file", F.lit(True).alias("recorded")).distinct()
    named = pending.select("source_file").join(recorded, "source_file", "left").orderBy("source_file")
    rows = named.limit(size + 1).collect()
    if len(rows) <= size:
        clashing = [r["source_file"] for r in rows if r["recorded"]]
        _refuse(len(clashing), min(clashing, default=None), max(clashing, default=None))
        if rows:
            yield [r["source_file"] for r in rows]
        return
    _refuse(*name_conflicts(pending, ledger).agg(F.count("*"), F.min("source_file"), F.max("source_file")).first())
    yield from _chunks((r["source_file"] for r in named.select("source_file").toLocalIterator()), size)


def _refuse(n: int, first: str | None, last: str | None) -> None:
    if n:
        raise ValueError(f"loaded before with other content: {n} files, from {first} to {last}")


def _write_pending(
    spark: SparkSession, source: SourceContract, paths: Sequence[str], warehouse: Warehouse, ledger: DataFrame
) -> DataFrame:
    """New files, one per content, as a table: hashing reads every byte and must not run twice."""
    path = warehouse.pending_path(source)
    hashed = checksum_files(spark, paths, source.file_glob)
    skip_known(first_of_each_content(hashed), ledger).select("source_file", "size_bytes", "file_checksum").write.mode(
        "overwrite"
    ).parquet(path)
    return spark.read.schema(PENDING_SCHEMA).parquet(path)


def _chunks(names: Iterable[str], size: int) -> Iterator[list[str]]:
    names = iter(names)
    while chunk := list(islice(names, size)):
        yield chunk


def _load_batch(
    spark: SparkSession,
    source: SourceContract,
    names: list[str],
    pending: DataFrame,
    warehouse: Warehouse,
    ingestion_ts: datetime,
    lease: Lease,
) -> int:
    """Raw rows, then the ledger entries. The rows are counted while they are written; counting them per file reads
    one column of what was written. A batch has ``files_per_batch`` entries at most, so they pass through the driver.
    """
    batch_id = warehouse.committed_batch(spark, source) + 1
    raw_dir = warehouse.batch_folder(warehouse.raw_path(source), batch_id, lease.token)
    counted = Observation()
    rows = scan_landing(spark, source, names, ingestion_ts).observe(counted, F.count(F.lit(1)).alias("n_rows"))
    with written_as_they_lie(spark):  # a task reads one split of a file, or several small files
        rows.write.mode("overwrite").partitionBy("partition").parquet(raw_dir)

    written = spark.read.schema(source.raw_schema).parquet(raw_dir)
    mine = pending.where(F.col("source_file").between(names[0], names[-1]))
    entries = ledger_entries(rows_per_file(mine, written), ingestion_ts).collect()
    _assert_complete(entries, counted.get["n_rows"], written)
    rows = spark.createDataFrame(entries, LEDGER_SCHEMA).coalesce(1)
    lease.check()
    rows.write.mode("overwrite").parquet(warehouse.batch_folder(warehouse.ledger_path(source), batch_id, lease.token))
    return batch_id


def _assert_complete(entries: Sequence[Row], n_written: int, written: DataFrame) -> None:
    """The ledger's constraints, before it is written: required values are there, and every raw row is accounted for.

    A count taken while writing also has the rows of tasks that ran twice, so it is taken again before it is believed.
    """
    missing = {c: n for c in REQUIRED if (n := sum(e[c] is None for e in entries))}
    if missing:
        raise RuntimeError(f"ledger entries without required values: {missing}")
    n_counted = sum(e["rows_ingested"] for e in entries)
    if n_counted != n_written:
        n_written = written.count()
    if n_counted != n_written:
        raise RuntimeError(f"the ledger would account for {n_counted} of {n_written} raw rows")
