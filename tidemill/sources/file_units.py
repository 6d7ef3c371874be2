"""Files as units: their names, sizes and content checksums."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.file_client import has_client, open_file_system
from tidemill.functions import bytes_checksum, size_kb
from tidemill.storage import escape_glob, qualified

#: Bytes of a file that a task holds at once.
BLOCK = 1 << 20

FILE_SOURCE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _files(spark: SparkSession, paths: Sequence[str], file_glob: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", file_glob)
    return reader.option("recursiveFileLookup", "true").load([escape_glob(p) for p in paths])


def list_files(spark: SparkSession, paths: str | Sequence[str], file_glob: str = "*.csv") -> DataFrame:
    """``source_file`` and ``size_bytes`` of every matching file; no content is read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return _files(spark, paths, file_glob).select(F.col("path").alias("source_file"), F.col("length").alias("size_bytes"))


def with_size_kb(files: DataFrame) -> DataFrame:
    return files.withColumn("size_kb", size_kb("size_bytes"))


def checksum_files(spark: SparkSession, paths: str | Sequence[str], file_glob: str = "*.csv") -> DataFrame:
    """``source_file, size_bytes, file_checksum``.

    Tasks read each file in blocks into a running digest, so a file of any size takes a block of memory. Spark deals
    the files out by size. Stores that only Spark's own client reaches give each file as one value,
    which Spark refuses beyond 2 GB, naming the file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    roots = {qualified(spark, path).split(":", 1)[0]: qualified(spark, path) for path in paths}
    if all(has_client(root) for root in roots.values()):
        schema = "source_file string, size_bytes bigint, file_checksum string"
        return list_files(spark, paths, file_glob).mapInArrow(_with_digests, schema)
    return _files(spark, paths, file_glob).select(
        F.col("path").alias("source_file"), F.col("length").alias("size_bytes"), bytes_checksum("content").alias("file_checksum")
    )


def _with_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column(0).to_pylist()
        digests = pa.array([_digest(name) for name in names], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, digests], ["source_file", "size_bytes", "file_checksum"])


def _digest(path: str) -> str:
    system, name = open_file_system(path)
    running = hashlib.sha256()
    with system.open_input_stream(name, compression=None) as content:
        while block := content.read(BLOCK):
            running.update(block)
    return running.hexdigest()


# Task functions travel by value, so the executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
