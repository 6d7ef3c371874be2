"""Moving consumed files out of the landing folder, after their rows are safe."""

from __future__ import annotations

import logging
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.file_client import open_file_system
from tidemill.sources.file_units import list_files
from tidemill.storage import delete_dir, glob_paths

log = logging.getLogger(__name__)
BLOCK = 8 * 1024 * 1024


def check_archive(incoming: str, archive_root: str) -> None:
    """Open both places, so that one without a client is an error before any row is loaded."""
    for path in (incoming, archive_root):
        try:
            open_file_system(path)
        except Exception as error:
            raise ValueError(f"no file system client for {path}: {error}") from error


def archive_files(files: DataFrame, incoming: str, archive_root: str, left_behind: str | None = None) -> int:
    """Move the listed files below ``archive_root``, keeping their place below ``incoming``.

    Tasks do the moving. A file that cannot be moved is logged and left: the ledger
    already knows its content, so the next batch run skips it and tries again; with ``left_behind``, a
    folder, its name is noted there for ``archive_again``. Returns the number of files that stayed behind.
    """
    root = "/" + open_file_system(incoming)[1].strip("/") + "/"

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            problems = [_move_one(path, root, archive_root) for path in batch["source_file"]]
            yield pd.DataFrame({"source_file": batch["source_file"], "problem": problems})

    spark = files.sparkSession
    moved = files.select("source_file").mapInPandas(move, "source_file string, problem string").where("problem is not null")
    if left_behind:
        folder = f"{left_behind}/n={1 + max(_notes(spark, left_behind), default=0)}"
        moved.write.mode("overwrite").parquet(folder)  # moved once; a repeated task finds its own earlier moves
        moved = spark.read.schema("source_file string, problem string").parquet(folder)
    left = moved.agg(
        F.count("*").alias("n"), F.first("source_file").alias("name"), F.first("problem").alias("problem")
    )
    row = left.first()
    if row["n"]:
        log.warning("%d files not archived, such as %s: %s", row["n"], row["name"], row["problem"])
    return row["n"]


def archive_again(spark: SparkSession, incoming: str, archive_root: str, left_behind: str) -> int:
    """Move the files that earlier runs noted as left behind and that are still there; those that stay are noted anew."""
    notes = _notes(spark, left_behind)
    folders = [f"{left_behind}/n={n}" for n in notes]
    if not folders:
        return 0
    names = spark.read.schema("source_file string").parquet(*folders).distinct().join(
        list_files(spark, incoming, "*").select("source_file"), "source_file", "left_semi"
    )
    stayed = 0 if names.isEmpty() else archive_files(names, incoming, archive_root, left_behind)
    for folder in folders:
        delete_dir(spark, folder)
    return stayed


def _notes(spark: SparkSession, left_behind: str) -> list[int]:
    return [int(path.rsplit("/", 2)[1].removeprefix("n=")) for path in glob_paths(spark, f"{left_behind}/n=*/_SUCCESS")]


def _move_one(path: str, root: str, archive_root: str) -> str | None:
    system, name = open_file_system(path)
    target_system, target_root = open_file_system(archive_root)
    below = ("/" + name.lstrip("/")).removeprefix(root)
    target = f"{target_root.rstrip('/')}/{below}"
    try:
        target_system.create_dir(target.rsplit("/", 1)[0], recursive=True)
        if system.equals(target_system):
            system.move(name, target)
        else:
            _copy_then_delete(system, name, target_system, target)
    except Exception as error:  # a repeated task finds its own earlier move
        from pyarrow.fs import FileType

        source_gone = system.get_file_info(name).type == FileType.NotFound
        target_there = target_system.get_file_info(target).type == FileType.File
        return None if source_gone and target_there else str(error)
    return None


def _copy_then_delete(system, name: str, target_system, target: str) -> None:
    """Between file systems: the source goes only when the copy has its size."""
    with system.open_input_stream(name) as source, target_system.open_output_stream(target) as sink:
        while block := source.read(BLOCK):
            sink.write(block)
    if target_system.get_file_info(target).size != system.get_file_info(name).size:
        raise OSError(f"the copy of {name} is incomplete")
    system.delete_file(name)


# Task functions travel by value, so the executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
