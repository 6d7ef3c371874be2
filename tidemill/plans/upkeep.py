"""Upkeep of a warehouse: many small batches into few folders, and what they replace dropped."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tidemill.contracts import SourceContract
from tidemill.plans.warehouse import Segment, Warehouse
from tidemill.storage import delete_dir, escape_glob, exclusive, glob_paths, total_bytes

#: Parquet that one task of a pack reads and writes, and so the size of the files that stay.
FILE_BYTES = 32 * 1024 * 1024
AT_A_TIME = 8


def to_pack(segments: list[Segment]) -> list[Segment]:
    """The newest segments that are worth one: each no larger than all that follow it.

    So a row is rewritten about as often as the number of batches can be halved, and as many
    segments stay at most.
    """
    taken, size = 0, 0
    for segment in reversed(segments):
        if segment.batches > max(size, 1):
            break
        taken, size = taken + 1, size + segment.batches
    return segments[len(segments) - taken :] if taken > 1 else []


def pack_batches(spark: SparkSession, source: SourceContract, warehouse: Warehouse) -> Segment | None:
    """Rewrite the newest small batches, raw rows and ledger entries, as one segment; None when there is nothing to gain.

    Rows keep their ``batch_id``, so incremental readers go on as before. The ledger's pack is the commit and
    is written last; until then, and for readers that listed before, the batches' own folders stand. A second writer fails.
    """
    with exclusive(spark, warehouse.lease_path(source.name)) as lease:
        chosen = to_pack(warehouse.cover(spark, source))
        if not chosen:
            return None
        pack = Segment(chosen[0].first, chosen[-1].last, f"batches={chosen[0].first}-{chosen[-1].last}-{lease.token}")
        _pack_rows(spark, source, warehouse, chosen, pack.folder)
        entries = warehouse.read_segments(spark, source, chosen, of_ledger=True).hint("rebalance")
        lease.check()
        entries.write.mode("overwrite").parquet(f"{warehouse.ledger_path(source)}/{pack.folder}")
        return pack


def _pack_rows(spark: SparkSession, source: SourceContract, warehouse: Warehouse, chosen: list[Segment], folder: str) -> None:
    """Raw rows of the segments, half-year by half-year: folders of one need no exchange to become few files, and no sort.

    A small half-year is one task, so several are written at a time.
    """
    path = warehouse.raw_path(source)
    found: dict[str, list[tuple[Segment, str]]] = {}
    for segment in chosen:
        for of_period in glob_paths(spark, f"{path}/{segment.folder}/partition=*"):
            found.setdefault(of_period.rsplit("/", 1)[1], []).append((segment, of_period))

    def write(name: str) -> None:
        n_files = -(-sum(total_bytes(spark, of_period) for _, of_period in found[name]) // FILE_BYTES)
        rows = warehouse.read_folders(spark, source, [(s, f"{s.folder}/{escape_glob(name)}") for s, _ in found[name]])
        rows.drop("partition").coalesce(max(1, n_files)).write.mode("overwrite").parquet(f"{path}/{folder}/{name}")

    with ThreadPoolExecutor(AT_A_TIME) as pool:
        list(pool.map(write, sorted(found)))


def expire_batches(spark: SparkSession, source: SourceContract, warehouse: Warehouse) -> int:
    """Drop folders of batches that a pack replaced, and of runs that never committed; for times without readers."""
    with exclusive(spark, warehouse.lease_path(source.name)):
        live = {s.folder for s in warehouse.cover(spark, source)}
        dropped = 0
        for path in (warehouse.ledger_path(source), warehouse.raw_path(source)):
            for pattern, parts in (("batch_id=*/run=*", 2), ("batches=*", 1)):
                for folder in glob_paths(spark, f"{path}/{pattern}"):
                    if "/".join(folder.rsplit("/", parts)[1:]) not in live:
                        delete_dir(spark, folder)
                        dropped += 1
            for folder in glob_paths(spark, f"{path}/batch_id=*"):
                if not glob_paths(spark, f"{folder}/run=*"):
                    delete_dir(spark, folder)
        return dropped
