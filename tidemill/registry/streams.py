"""File streams, and the batch twins they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemill.operators.keyed_table import KeyedTable
from tidemill.operators.latest import latest_per_key, newest_first
from tidemill.plans.fuel_prices import SOURCE
from tidemill.plans.warehouse import Warehouse
from tidemill.registry.files import FILE_ROWS_SQL, ROWS_PER_PARTITION_SQL, file_rows, landed
from tidemill.registry.raw_prices import table
from tidemill.sources.csv_files import scan_landing
from tidemill.sources.file_units import list_files
from tidemill.storage import copy_file, scratch_dir
from tidemill.streaming.file_stream import ingest_stream
from tidemill.streaming.latest_stream import upsert_stream

EVENT_KEY = ("user_id", "event_type")
EVENT_ORDER = ("ts", "event_id", "value", "props")
EVENT_FILES = 9


def stream_ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing folder with one file twice under different names, as a stream."""
    root = landed(spark, sf_dir, "stream")
    incoming = f"{root}/incoming/{SOURCE.name}"
    first = list_files(spark, incoming, SOURCE.file_glob).agg(F.min("source_file")).first()[0]
    copy_file(spark, first, f"{first.rsplit('/', 1)[0]}/twin.csv")
    warehouse = Warehouse(f"{root}/warehouse")
    ingest_stream(
        spark, SOURCE, incoming, warehouse, f"{root}/checkpoint", files_per_trigger=8
    ).awaitTermination()
    return file_rows(warehouse.read_raw(spark, SOURCE))


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per half-year in the archive alone after the stream."""
    root = landed(spark, sf_dir, "stream-archive")
    warehouse = Warehouse(f"{root}/warehouse")
    ingest_stream(
        spark,
        SOURCE,
        f"{root}/incoming/{SOURCE.name}",
        warehouse,
        f"{root}/checkpoint",
        archive_root=f"{root}/processed",
        files_per_trigger=8,
    ).awaitTermination()
    kept = scan_landing(spark, SOURCE, f"{root}/processed")
    return kept.groupBy("partition").agg(F.count("*").alias("n_rows"))


def events_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "events"), EVENT_KEY, newest_first(EVENT_ORDER))


def stream_events_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in several files, so that the stream has several micro-batches, then compacted."""
    events = table(spark, sf_dir, "events")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in events.schema.fields])
    root = scratch_dir(spark, "stream-latest")
    events.repartition(EVENT_FILES).write.parquet(f"{root}/events")
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", EVENT_FILES // 3).parquet(f"{root}/events")
    newest = KeyedTable(f"{root}/events_latest", schema, EVENT_KEY, EVENT_ORDER)
    upsert_stream(rows, newest, f"{root}/checkpoint").awaitTermination()
    newest.compact(spark)
    return newest.read(spark)


QUERIES = {
    "events_latest": events_latest,
    "stream_events_latest": stream_events_latest,
    "stream_ingest_once": stream_ingest_once,
    "stream_archive": stream_archive,
}

_EVENTS_LATEST_SQL = """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC, value DESC, props DESC) AS rn
      FROM events)
    WHERE rn = 1"""

ORACLES = {
    "events_latest": _EVENTS_LATEST_SQL,
    "stream_events_latest": _EVENTS_LATEST_SQL,
    "stream_ingest_once": FILE_ROWS_SQL,
    "stream_archive": ROWS_PER_PARTITION_SQL,
}
