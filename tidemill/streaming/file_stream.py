"""Files picked up as they arrive, loaded by the batch code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemill.contracts import SourceContract
from tidemill.plans.archive import archive_again, archive_files, check_archive
from tidemill.plans.ingest import load_files
from tidemill.plans.warehouse import Warehouse
from tidemill.sources.file_units import FILE_SOURCE_SCHEMA
from tidemill.storage import still_there


def ingest_stream(
    spark: SparkSession,
    source: SourceContract,
    incoming: str,
    warehouse: Warehouse,
    checkpoint: str,
    archive_root: str | None = None,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Load the files that have arrived since the last run, then stop.

    The stream carries file names only; each micro-batch hands its names to the batch
    loader, whose ledger makes a repeated micro-batch harmless. ``files_per_trigger=1``
    commits file by file. With ``archive_root`` the files of a micro-batch are moved as soon as the
    ledger has them; a micro-batch repeated after that finds them gone and has nothing to do. Files
    that a run could not move are noted, and the next run begins with them.
    """
    left_behind = warehouse.left_behind_path(source)
    if archive_root:
        check_archive(incoming, archive_root)
        archive_again(spark, incoming, archive_root, left_behind)
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SOURCE_SCHEMA)
        .option("pathGlobFilter", source.file_glob)
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
    )

    def load(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        names = [row["path"] for row in batch.collect()]  # at most files_per_trigger names
        names = still_there(session, names)
        if names:
            load_files(session, source, names, warehouse, files_per_batch=files_per_trigger)
            if archive_root:
                moving = session.createDataFrame([(name,) for name in names], "source_file string")
                archive_files(moving, incoming, archive_root, left_behind)

    return (
        reader.load(incoming)
        .select("path")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
