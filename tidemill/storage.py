"""Directory names on the session's own file system: listing, existence, scratch space.

Only file *names* pass through here. Rows are always read and written by Spark.
"""

from __future__ import annotations

import json
import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a Hadoop glob, sorted; empty when nothing matches."""
    fs, jpath = _hadoop(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(jpath) or [])


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's listings name it."""
    fs, jpath = _hadoop(spark, path)
    return fs.makeQualified(jpath).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath)


def still_there(spark: SparkSession, names: list[str]) -> list[str]:
    """Those of the given files that exist, by one listing per folder."""
    folders = sorted({name.rsplit("/", 1)[0] for name in names})
    found = {path for folder in folders for path in glob_paths(spark, escape_glob(folder) + "/*")}
    return [name for name in names if name in found]


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def total_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files of a folder."""
    fs, jpath = _hadoop(spark, path)
    return fs.getContentSummary(jpath).getLength()


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop(spark, path)
    fs.delete(jpath, True)


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    fs, jsource = _hadoop(spark, source)
    _, jtarget = _hadoop(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        fs, jsource, fs, jtarget, False, spark._jsc.hadoopConfiguration()
    )


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _hadoop(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = _hadoop(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


#: Files that a task of ``written_as_they_lie`` writes at the same time.
OPEN_FILES = 32
#: Parquet of which a task makes wide rows; in memory they take some ten times as much.
SPLIT_BYTES = 32 * 1024 * 1024
#: A lease that was neither released nor renewed for so long belongs to a dead run.
LEASE_SECONDS = 6 * 3600


@dataclass(frozen=True)
class Lease:
    """The right to commit below a lease folder, good while no later token is there."""

    spark: SparkSession
    folder: str
    token: int
    owner: str

    @property
    def path(self) -> str:
        return f"{self.folder}/token={self.token:09d}"

    def check(self) -> None:
        """Before every commit: fails once another run has taken over, else holds the lease for longer."""
        if max(_tokens(self.spark, self.folder), default=0) != self.token:
            raise RuntimeError(f"{self.owner} lost its lease {self.path}: another writer took over")
        self.write(time.time() + LEASE_SECONDS)

    def write(self, until: float) -> None:
        write_text(self.spark, self.path, json.dumps({"owner": self.owner, "until": until}))


def _tokens(spark: SparkSession, folder: str) -> list[int]:
    return [int(path.rsplit("=", 1)[1]) for path in glob_paths(spark, f"{folder}/token=*")]


def _holder(spark: SparkSession, folder: str, token: int) -> str | None:
    """Who holds a token still; None when it was given back or has run out."""
    path = f"{folder}/token={token:09d}"
    text = read_text(spark, path)
    if not text:  # taken a moment ago, or by a run that died in that moment
        fs, jpath = _hadoop(spark, path)
        text = json.dumps({"owner": "another writer", "until": fs.getFileStatus(jpath).getModificationTime() / 1000 + LEASE_SECONDS})
    state = json.loads(text)
    return state["owner"] if state["until"] > time.time() else None


@contextmanager
def exclusive(spark: SparkSession, path: str) -> Iterator[Lease]:
    """Hold the lease below ``path``; another holder is an error, and so is a session without commit markers.

    File systems make a file for one caller only, so of two writers one gets the next token and the other fails at
    once. A run that died keeps its token for ``LEASE_SECONDS`` after its last commit; then the next run takes a later
    one, and should the dead run come back, ``Lease.check`` keeps it from committing.
    """
    conf = spark._jsc.hadoopConfiguration()
    if not conf.getBoolean("mapreduce.fileoutputcommitter.marksuccessfuljobs", True):
        raise RuntimeError("commits rely on _SUCCESS files: mapreduce.fileoutputcommitter.marksuccessfuljobs is off")
    fs, jfolder = _hadoop(spark, path)
    fs.mkdirs(jfolder)
    tokens = _tokens(spark, path)
    newest = max(tokens, default=0)
    owner = _holder(spark, path, newest) if newest else None
    lease = Lease(spark, path, newest + 1, f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}")
    if owner or not fs.createNewFile(_hadoop(spark, lease.path)[1]):
        raise RuntimeError(f"another writer holds {path}: {owner or 'it began just now'}")
    lease.write(time.time() + LEASE_SECONDS)
    for token in tokens:
        fs.delete(_hadoop(spark, f"{path}/token={token:09d}")[1], False)
    try:
        yield lease
    finally:
        if max(_tokens(spark, path), default=0) == lease.token:
            lease.write(0)


@contextmanager
def written_as_they_lie(spark: SparkSession) -> Iterator[None]:
    """Inside, a write by partition keeps the files of ``OPEN_FILES`` partitions open in a task and does not sort its rows.

    For tasks whose rows are of few partitions, or few altogether; of more partitions the rest is sorted by Spark.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Inside, a task reads ``SPLIT_BYTES`` of files at most: for plans that sort the wide rows made of them."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    n_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(name, f"{min(SPLIT_BYTES, n_bytes)}b")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, a finished write drops its shuffle files at once, and not when the driver's garbage happens to be collected.

    For frames that are executed once: a second execution would shuffle anew.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def escape_glob(path: str) -> str:
    """A literal path as the glob that matches only it (readers expand globs)."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory below the shared folder named in ``spark.checkpoint.dir``.

    Without that setting only a local session gets a folder of its own; a cluster
    must name one that every executor sees. Removed when the JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemill-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base}/tidemill-{label}-{uuid.uuid4().hex}"
    fs, jpath = _hadoop(spark, path)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    if (made := _made.get()) is not None:
        made.append(path)
    return path


#: Scratch folders made since the innermost ``scratch_released`` began.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch_released(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made inside are deleted at the end. What outlives them goes to a folder made before."""
    folders: list[str] = []
    token = _made.set(folders)
    try:
        yield
    finally:
        _made.reset(token)
        for folder in folders:
            delete_dir(spark, folder)
