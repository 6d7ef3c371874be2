"""A Parquet table with one row per key, changed by whole-slice replacement.

Every change writes a new directory ``v=<number>-<mark>-<full|part|delta>`` with one
sub-directory per slice. A version counts once its ``_SUCCESS`` file exists, so a job
that dies half-way leaves the table as it was and its retry overwrites the remains. The
content of a slice is its newest committed directory. A ``delta`` version holds the newest
rows of one small batch and lies over the slices until ``compact``: readers keep the newest
row per key over both, so adding a delta costs what the batch holds. ``mark`` is how far into its input
a writer has come (the last raw batch, or the last micro-batch of one checkpoint); a version
names its writer, so the numbers of one are never compared with another's. Merging and adding
keep the newest of newest rows, so doing either twice changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemill.operators.latest import latest_of_stored, latest_per_key, newest_first
from tidemill.operators.upsert import merge_latest
from tidemill.storage import delete_dir, escape_glob, glob_paths, shuffles_released, small_splits

_VERSION = re.compile(r"/v=(\d+)-(-?\d+)-(full|part|delta)(?:-w(\w+))?(?:-r(\d+))?(?=/|$)")
_SLICE = "_table_slice"
# Directory name Spark gives to a NULL or empty partition value.
_NULL_SLICE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Version:
    number: int
    mark: int
    kind: str
    writer: str
    run: int
    path: str


@dataclass(frozen=True)
class KeyedTable:
    root: str
    schema: T.StructType
    key: str | tuple[str, ...]
    tie_order: tuple[str, ...]
    slice_of: Callable[[], Column] | None = None
    #: Number of the run that writes: runs never share a folder, so one that lost its lease can't add files to another's.
    run: int = 0

    def versions(self, spark: SparkSession) -> list[Version]:
        """Committed versions, newest first."""
        found = []
        for marker in glob_paths(spark, f"{self.root}/v=*/_SUCCESS"):
            number, mark, kind, writer, run = _VERSION.search(marker).groups()
            found.append(Version(int(number), int(mark), kind, writer or "", int(run or 0), marker.rsplit("/", 1)[0]))
        return sorted(found, key=lambda v: (v.number, v.run), reverse=True)

    def mark(self, spark: SparkSession, writer: str = "") -> int | None:
        """Mark of this writer's newest version; None before its first."""
        return next((v.mark for v in self.versions(spark) if v.writer == writer), None)

    def slices(self, spark: SparkSession) -> dict[str, str]:
        """Current directory of every slice. One glob; as many names as slices ever written."""
        versions = self.versions(spark)
        by_version: dict[str, list[str]] = {}
        for path in glob_paths(spark, f"{self.root}/v=*/{_SLICE}=*"):
            by_version.setdefault(path.rsplit("/", 1)[0], []).append(path)
        current: dict[str, str] = {}
        for version in versions:
            if version.kind == "delta":
                continue
            for path in by_version.get(version.path, []):
                current.setdefault(unquote(path.rsplit("=", 1)[1]), path)
            if version.kind == "full":
                break
        return current

    def deltas(self, spark: SparkSession) -> list[str]:
        """Directories of the deltas since the last full version."""
        found = []
        for version in self.versions(spark):
            if version.kind == "full":
                break
            if version.kind == "delta":
                found.append(version.path)
        return found

    def read(self, spark: SparkSession, slices: list[str] | None = None) -> DataFrame:
        """The newest row per key of the given slices (all by default), deltas included."""
        rows, over = self._rows(spark, slices)
        return latest_per_key(rows, self.key, newest_first(self.tie_order)) if over else rows

    def _rows(self, spark: SparkSession, slices: list[str] | None = None) -> tuple[DataFrame, bool]:
        """Rows of the given slices as they lie, those of the deltas included, and whether there are deltas."""
        current = self.slices(spark)
        paths = [p for name, p in sorted(current.items()) if slices is None or name in slices]
        base = spark.read.schema(self.schema).parquet(*[escape_glob(p) for p in paths]) if paths else None
        over = self.deltas(spark)
        if not over:
            return spark.createDataFrame([], self.schema) if base is None else base, False
        rows = spark.read.schema(self.schema).parquet(*[escape_glob(p) for p in over])
        if slices is not None:
            mine = F.coalesce(F.nullif(F.col(_SLICE), F.lit("")), F.lit(_NULL_SLICE)).isin(slices)
            rows = self._with_slice(rows).where(mine).drop(_SLICE)
        return rows if base is None else base.union(rows), True

    def read_units(self, spark: SparkSession, units: list[tuple[str, str]]) -> list[DataFrame]:
        """Rows of the given slices of the given version folders, with columns ``version`` and ``slice``; a frame per version."""
        schema = T.StructType([*self.schema.fields, T.StructField(_SLICE, T.StringType())])
        current, by_version = self.slices(spark), {}
        for version, name in units:
            by_version.setdefault(version, []).append(escape_glob(current[name]))
        name = F.coalesce(F.nullif(F.col(_SLICE), F.lit("")), F.lit(_NULL_SLICE)).alias("slice")
        return [
            spark.read.schema(schema)
            .option("basePath", f"{self.root}/{version}")
            .parquet(*paths)
            .select(F.lit(version).alias("version"), name, *[F.col(f"`{n}`") for n in self.schema.names])
            for version, paths in by_version.items()
        ]

    def replace(self, df: DataFrame, mark: int, stored: bool = False) -> None:
        """Full build: newest row per key of ``df`` becomes the whole table.

        ``stored``, here and in ``merge``: ``df`` reads files and may be read again, so only rows of repeated keys are moved.
        """
        latest = latest_of_stored if stored else latest_per_key
        self._publish(latest(df, self.key, newest_first(self.tie_order)), mark, "full")

    def merge(self, df: DataFrame, mark: int, stored: bool = False) -> None:
        """Upsert: rewrite only the slices ``df`` touches, keeping the newest row per key."""
        spark = df.sparkSession
        touched = self._touched(df)
        current, _ = self._rows(spark, touched)
        rows = merge_latest(current, df.select(*self.schema.names), self.key, newest_first(self.tie_order), stored)
        self._publish(rows, mark, "part")

    def append(self, df: DataFrame, mark: int, writer: str = "") -> None:
        """Upsert by a delta: writes the newest rows of ``df`` and reads nothing of the table."""
        self._publish(latest_per_key(df.select(*self.schema.names), self.key, newest_first(self.tie_order)), mark, "delta", writer)

    def compact(self, spark: SparkSession) -> None:
        """Fold the deltas into a new full version."""
        if self.deltas(spark):
            mark = self.mark(spark)
            self.replace(self._rows(spark)[0], -1 if mark is None else mark, stored=True)

    def expire(self, spark: SparkSession) -> int:
        """Drop slices that a newer version replaced and deltas folded into one; for times without readers."""
        live = set(self.slices(spark).values()) | set(self.deltas(spark))
        committed = {v.path for v in self.versions(spark)}
        stale = [
            p
            for p in glob_paths(spark, f"{self.root}/v=*/{_SLICE}=*")
            if p not in live and p.rsplit("/", 1)[0] in committed
        ]
        stale += [v.path for v in self.versions(spark) if v.kind == "delta" and v.path not in live]
        for path in stale:
            delete_dir(spark, path)
        return len(stale)

    def _touched(self, df: DataFrame) -> list[str] | None:
        """Slices the batch has rows of: a few names, from the columns that make the slice."""
        if self.slice_of is None:
            return None
        return [row[0] or _NULL_SLICE for row in self._with_slice(df).select(_SLICE).distinct().collect()]

    def _with_slice(self, df: DataFrame) -> DataFrame:
        value = self.slice_of().cast("string") if self.slice_of else F.lit("all")
        return df.withColumn(_SLICE, value)

    def _publish(self, rows: DataFrame, mark: int, kind: str, writer: str = "") -> None:
        """Every task holds rows of every slice and writes a file for each: as many as there are tasks, which are sized
        by the data, so that the wide rows of one are sorted by slice without spilling. An exchange by slice would leave
        fewer files, and move every row once more. Shuffles are dropped when the rows are written.
        """
        versions = self.versions(rows.sparkSession)
        number = versions[0].number + 1 if versions else 0
        path = f"{self.root}/v={number:06d}-{mark}-{kind}" + (f"-w{writer}" if writer else "") + (f"-r{self.run}" if self.run else "")
        with small_splits(rows.sparkSession), shuffles_released(rows.sparkSession):
            if kind == "delta":
                rows.write.mode("overwrite").parquet(path)
            else:
                self._with_slice(rows).write.mode("overwrite").partitionBy(_SLICE).parquet(path)

