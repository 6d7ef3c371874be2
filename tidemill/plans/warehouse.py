"""Where the tables live, and how the raw table and the ledger are read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemill.contracts import ModelContract, SourceContract
from tidemill.functions import partition_of_path
from tidemill.operators.keyed_table import KeyedTable
from tidemill.operators.ledger import LEDGER_SCHEMA, loads_with_rows
from tidemill.sources.periods import resolve_periods
from tidemill.storage import glob_paths

BATCH = T.StructField("batch_id", T.LongType(), False)


@dataclass(frozen=True)
class Segment:
    """Batches ``first`` to ``last`` in one folder of the ledger, and of the raw table."""

    first: int
    last: int
    folder: str

    @property
    def packed(self) -> bool:
        return self.folder.startswith("batches=")

    @property
    def batches(self) -> int:
        return self.last - self.first + 1


@dataclass(frozen=True)
class Warehouse:
    """One folder with a raw table and a ledger per source and a table per model.

    A raw batch counts once its ledger directory is complete. Batches are numbered one
    by one and a failed number is used again, so the committed ones are known by name; no join
    with the ledger is needed to read the raw table. Runs of small batches are packed into
    one folder (``plans.upkeep.pack_batches``), so readers list few folders however many batches there were.
    """

    root: str
    raw_namespace: str = "raw"
    control_namespace: str = "control_file"
    model_namespace: str = "staging"

    def raw_path(self, source: SourceContract) -> str:
        return f"{self.root}/{self.raw_namespace}/{source.table}"

    def ledger_path(self, source: SourceContract) -> str:
        return f"{self.root}/{self.control_namespace}/processed_files/{source.name}"

    def pending_path(self, source: SourceContract) -> str:
        return f"{self.root}/{self.control_namespace}/pending_files/{source.name}"

    def left_behind_path(self, source: SourceContract) -> str:
        return f"{self.root}/{self.control_namespace}/left_behind/{source.name}"

    def lease_path(self, name: str) -> str:
        return f"{self.root}/{self.control_namespace}/leases/{name}"

    def model_table(self, model: ModelContract) -> KeyedTable:
        path = f"{self.root}/{self.model_namespace}/{model.table}"
        return KeyedTable(path, model.schema, model.key, tuple(model.tie_order), model.slice_of)

    @staticmethod
    def batch_folder(path: str, batch_id: int, run: int) -> str:
        """Folder of a batch as one run writes it; runs never share one, so a late one can't add files to another's."""
        return f"{path}/batch_id={batch_id}/run={run}"

    def committed_batch(self, spark: SparkSession, source: SourceContract) -> int:
        """Number of the last complete batch, 0 before the first."""
        return max((s.last for s in self.segments(spark, source)), default=0)

    def segments(self, spark: SparkSession, source: SourceContract) -> list[Segment]:
        """Committed batches, one by one and packed (``plans.upkeep``), by the ledger's markers. Of two runs that committed
        one batch the later counts."""
        singles: dict[int, int] = {}
        for path in glob_paths(spark, f"{self.ledger_path(source)}/batch_id=*/run=*/_SUCCESS"):
            batch, run = (int(part.split("=")[1]) for part in path.rsplit("/", 3)[1:3])
            singles[batch] = max(run, singles.get(batch, 0))
        found = [Segment(n, n, f"batch_id={n}/run={run}") for n, run in singles.items()]
        for path in glob_paths(spark, f"{self.ledger_path(source)}/batches=*/_SUCCESS"):
            folder = path.rsplit("/", 2)[1]
            first, last = (int(n) for n in folder.removeprefix("batches=").split("-")[:2])
            found.append(Segment(first, last, folder))
        return found

    def cover(self, spark: SparkSession, source: SourceContract, after: int = 0) -> list[Segment]:
        """The fewest segments with all batches later than ``after``; the first may begin earlier."""
        found, out, n = self.segments(spark, source), [], after + 1
        last = max((s.last for s in found), default=0)
        while n <= last:
            best = max((s for s in found if s.first <= n <= s.last), key=lambda s: s.last, default=None)
            if best is None:
                raise RuntimeError(f"batch {n} of {self.ledger_path(source)} is missing, though {last} is there")
            out.append(best)
            n = best.last + 1
        return out

    def read_raw(self, spark: SparkSession, source: SourceContract, after: int = 0) -> DataFrame:
        """Committed raw rows of the batches later than ``after``, with their ``batch_id``."""
        return self.read_segments(spark, source, self.cover(spark, source, after)).where(F.col("batch_id") > after)

    def read_ledger(self, spark: SparkSession, source: SourceContract) -> DataFrame:
        return self.read_segments(spark, source, self.cover(spark, source), of_ledger=True)

    def read_segments(
        self, spark: SparkSession, source: SourceContract, segments: Sequence[Segment], of_ledger: bool = False
    ) -> DataFrame:
        """Rows of the given segments. Their folders are named, so no other is listed."""
        return self.read_folders(spark, source, [(s, s.folder) for s in segments], of_ledger)

    def read_folders(
        self, spark: SparkSession, source: SourceContract, folders: Sequence[tuple[Segment, str]], of_ledger: bool = False
    ) -> DataFrame:
        """Rows of the given folders, each of a segment or of one half-year of it."""
        path = self.ledger_path(source) if of_ledger else self.raw_path(source)
        schema = T.StructType([*(LEDGER_SCHEMA if of_ledger else source.raw_schema).fields, BATCH])
        columns = [F.col(f"`{n}`") for n in schema.names]
        parts = []
        if singles := [f"{path}/{folder}" for s, folder in folders if not s.packed]:
            parts.append(spark.read.schema(schema).option("basePath", path).parquet(*singles).select(*columns))
        if packs := [f"{path}/{folder}" for s, folder in folders if s.packed]:
            parts.append(spark.read.schema(schema).option("basePath", path).parquet(*packs).select(*columns))
        return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)

    def periods(self, spark: SparkSession, source: SourceContract) -> DataFrame:
        """Half-years with committed raw rows. The ledger knows them; no raw folder is listed."""
        return self._batches_of_periods(spark, source).select("partition").distinct()

    def _batches_of_periods(self, spark: SparkSession, source: SourceContract) -> DataFrame:
        loaded = loads_with_rows(self.read_ledger(spark, source))
        return loaded.select(partition_of_path("source_file").alias("partition"), "batch_id").where("partition is not null")

    def rows_of_period(self, spark: SparkSession, source: SourceContract, wanted: str) -> DataFrame:
        """Raw rows of the wanted half-year or, when it has none, of the one before it; neither is an error.

        Only the segments that hold it are listed, and of them only its folders are read.
        """
        present = self._batches_of_periods(spark, source)
        asked = spark.createDataFrame([(wanted,)], "wanted string")
        resolved = resolve_periods(asked, present.select("partition")).first()["resolved"]
        if resolved is None:
            raise FileNotFoundError(f"no rows for {wanted} nor for the half-year before it")
        numbers = {r["batch_id"] for r in present.where(F.col("partition") == resolved).select("batch_id").distinct().collect()}
        holding = [s for s in self.cover(spark, source) if not numbers.isdisjoint(range(s.first, s.last + 1))]
        return self.read_segments(spark, source, holding).where(F.col("partition") == resolved)

    def register_views(self, spark: SparkSession, source: SourceContract, *models: ModelContract) -> None:
        """Temporary views under the table names, for SQL users."""
        self.read_raw(spark, source).drop("batch_id").createOrReplaceTempView(source.table)
        self.read_ledger(spark, source).drop("batch_id").createOrReplaceTempView("processed_files")
        for model in models:
            self.model_table(model).read(spark).createOrReplaceTempView(model.table)
