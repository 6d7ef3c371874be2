"""Files: scans, landing layout, checksums, ledger, batch ingestion."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.contracts import resolve_namespace
from tidemill.functions import batch_stamp, landing_path, next_period, partition_of_path, period_of, size_kb, text_checksum
from tidemill.operators import ledger
from tidemill.operators.describe import describe_columns
from tidemill.plans.fuel_prices import MODEL, SOURCE
from tidemill.plans.ingest import ingest
from tidemill.plans.staging import full_model
from tidemill.plans.upkeep import expire_batches, pack_batches
from tidemill.plans.warehouse import Warehouse
from tidemill.registry.raw_prices import raw_prices, table, with_model, with_raw
from tidemill.sources import tables
from tidemill.sources.csv_files import land_csv, scan_landing
from tidemill.sources.periods import resolve_periods, rows_of_period
from tidemill.storage import scratch_dir

LOAD_TIME = datetime(2025, 7, 1)


def landed(spark: SparkSession, sf_dir: str, label: str) -> str:
    """The raw price rows as CSV files in a scratch landing folder."""
    root = scratch_dir(spark, label)
    land_csv(raw_prices(spark, sf_dir, by_period=True), SOURCE, f"{root}/incoming", gathered=True)
    return root


def file_rows(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`{c.name}`") for c in SOURCE.columns], "partition")


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landed(spark, sf_dir, "csv-scan")
    return file_rows(scan_landing(spark, SOURCE, f"{root}/incoming"))


def ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landed(spark, sf_dir, "ingest")
    warehouse = Warehouse(f"{root}/warehouse")
    for _ in range(2):
        ingest(spark, SOURCE, f"{root}/incoming", warehouse, LOAD_TIME)
    return file_rows(warehouse.read_raw(spark, SOURCE))


def _packed(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    """A warehouse loaded in several small batches, packed, and rid of what the pack replaced."""
    root = landed(spark, sf_dir, label)
    warehouse = Warehouse(f"{root}/warehouse")
    ingest(spark, SOURCE, f"{root}/incoming", warehouse, LOAD_TIME, files_per_batch=6)
    pack_batches(spark, SOURCE, warehouse)
    expire_batches(spark, SOURCE, warehouse)
    return warehouse


def ingest_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_rows(_packed(spark, sf_dir, "packed").read_raw(spark, SOURCE))


def period_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A half-year of the packed warehouse, asked for by the one after the last: the one before it answers."""
    warehouse = _packed(spark, sf_dir, "packed-period")
    return file_rows(warehouse.rows_of_period(spark, SOURCE, _after_last(spark, sf_dir)))


def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per half-year as the ledger has them after an ingestion."""
    root = landed(spark, sf_dir, "ledger")
    warehouse = Warehouse(f"{root}/warehouse")
    ingest(spark, SOURCE, f"{root}/incoming", warehouse, LOAD_TIME)
    loaded = warehouse.read_ledger(spark, SOURCE)
    return loaded.groupBy(partition_of_path("source_file").alias("partition"), "load_status").agg(
        F.sum("rows_ingested").alias("n_rows"),
        F.max("ingestion_ts").alias("loaded_at"),
        (F.count_distinct("file_checksum") == F.count("source_file")).alias("contents_differ"),
    )


def ingest_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per half-year in the archive after an ingestion that moves its files."""
    root = landed(spark, sf_dir, "archive")
    ingest(
        spark, SOURCE, f"{root}/incoming", Warehouse(f"{root}/warehouse"), LOAD_TIME, archive_root=f"{root}/processed"
    )
    archived = scan_landing(spark, SOURCE, f"{root}/processed")
    return archived.groupBy("partition").agg(F.count("*").alias("n_rows"))


def rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_prices(spark, sf_dir)
    loaded = raw.where(F.col("`Valor de Compra`").isNotNull())
    return ledger.rows_per_file(raw.select("source_file").distinct(), loaded)


def partition_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = table(spark, sf_dir, "orders").groupBy(period_of("o_orderdate").alias("period")).agg(
        F.max("o_orderdate").alias("last_day"), F.count("*").alias("n_rows")
    )
    path = landing_path(SOURCE.name, SOURCE.file_prefix, "period", batch_stamp("last_day"))
    return periods.select("period", path.alias("landing_path"), "n_rows")


def partition_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_prices(spark, sf_dir)
    return raw.groupBy(partition_of_path("source_file").alias("from_path"), "partition").agg(
        F.count("*").alias("n_rows")
    )


def semester_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "orders").select(next_period(period_of("o_orderdate")).alias("wanted"))
    counts = table(spark, sf_dir, "lineitem").groupBy(period_of("l_shipdate").alias("partition")).agg(
        F.count("*").alias("n_rows")
    )
    return resolve_periods(wanted, counts)


def period_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table partitioned by half-year, read for a period after its last: the one before it answers."""
    path = f"{scratch_dir(spark, 'period')}/prices"
    raw_prices(spark, sf_dir).write.partitionBy("partition").parquet(path)
    stored = spark.read.schema(SOURCE.raw_schema).parquet(path)
    return file_rows(rows_of_period(stored, _after_last(spark, sf_dir)))


def _after_last(spark: SparkSession, sf_dir: str) -> str:
    return table(spark, sf_dir, "lineitem").agg(period_of(F.max("l_shipdate")).alias("p")).select(next_period("p")).first()[0]


def content_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), text_checksum("text").alias("file_checksum")
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), text_checksum("html").alias("file_checksum")
    )
    return documents.unionByName(pages)


def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "pages").select("page_id", F.octet_length("html").cast("long").alias("size_bytes"))
    return sized.withColumn("size_kb", size_kb("size_bytes"))


def _document_files(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.concat(F.lit("documents/"), F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(".txt")).alias(
            "source_file"
        ),
        F.size(F.split("text", "\n")).cast("long").alias("rows_ingested"),
        text_checksum("text").alias("file_checksum"),
    )


def _all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_files(table(spark, sf_dir, "documents"))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents are the files loaded so far."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return ledger.ledger_entries(ledger.first_of_each_content(_document_files(labelled)), LOAD_TIME)


def ledger_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir)


def ledger_skip_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = ledger.first_of_each_content(_all_files(spark, sf_dir))
    return ledger.skip_known(new, _ledger(spark, sf_dir)).select("source_file", "rows_ingested", "file_checksum")


def ledger_known_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = ledger.only_known(_all_files(spark, sf_dir), _ledger(spark, sf_dir))
    return known.select("source_file", "file_checksum")


def ledger_name_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled content arriving under the name of a loaded document."""
    renamed = _all_files(spark, sf_dir).withColumn("file_checksum", F.sha2(F.concat("file_checksum", "source_file"), 256))
    conflicts = ledger.name_conflicts(renamed, _ledger(spark, sf_dir))
    return conflicts.select("source_file", "file_checksum")


def table_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "tables")
    namespace = resolve_namespace(f" tidemill_{uuid.uuid4().hex} ", "default")
    tables.ensure_namespace(spark, namespace, f"{root}/{namespace}")
    counts = raw_prices(spark, sf_dir).groupBy("partition").agg(F.count("*").alias("n_rows"))
    path = f"{root}/{SOURCE.table}"
    try:
        counts.write.option("path", path).saveAsTable(f"{namespace}.{SOURCE.table}")
        present = tables.table_exists(spark, namespace, SOURCE.table)
        absent = tables.table_exists(spark, namespace, f"{SOURCE.table}_absent")
    finally:
        spark.sql(f"DROP DATABASE {namespace} CASCADE")  # an external table: its files stay
    stored = spark.read.schema(counts.schema).parquet(path)
    return stored.select("partition", "n_rows", F.lit(present).alias("present"), F.lit(absent).alias("absent"))


def contract_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = describe_columns(full_model(raw_prices(spark, sf_dir), MODEL))
    has_comment = (F.length("comment") > 0).alias("has_comment")
    return described.select("position", "column_name", "data_type", has_comment, "non_null_rows")


QUERIES = {
    "csv_scan": csv_scan,
    "ingest_batch": ingest_batch,
    "ingest_packed": ingest_packed,
    "period_packed": period_packed,
    "ingest_ledger": ingest_ledger,
    "ingest_archive": ingest_archive,
    "rows_per_file": rows_per_file,
    "partition_layout": partition_layout,
    "partition_from_path": partition_from_path,
    "semester_fallback": semester_fallback,
    "period_rows": period_rows,
    "content_checksum": content_checksum,
    "file_sizes": file_sizes,
    "ledger_build": ledger_build,
    "ledger_skip_anti": ledger_skip_anti,
    "ledger_known_semi": ledger_known_semi,
    "ledger_name_conflict": ledger_name_conflict,
    "table_exists": table_exists,
    "contract_describe": contract_describe,
}

# An empty field and an empty quoted field both read back as NULL.
_FILE_COLUMNS_SQL = ", ".join(f"""nullif("{c.name}", '') AS "{c.name}\"""" for c in SOURCE.columns)
FILE_ROWS_SQL = with_raw(f'SELECT {_FILE_COLUMNS_SQL}, "partition" FROM raw_prices')
ROWS_PER_PARTITION_SQL = with_raw(
    'SELECT "partition", count(*) AS n_rows FROM raw_prices GROUP BY "partition"'
)

_FILES_SQL = """
    WITH files AS (
      SELECT doc_id, 'documents/' || lpad(CAST(doc_id AS VARCHAR), 12, '0') || '.txt' AS source_file,
        length(text) - length(replace(text, chr(10), '')) + 1 AS rows_ingested, sha256(text) AS file_checksum
      FROM documents),
    known AS (
      SELECT file_checksum, min(source_file) AS source_file, arg_min(rows_ingested, source_file) AS rows_ingested
      FROM files WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY file_checksum)
"""
_TYPES = {"decimal(10,2)": ("valor_venda", "valor_compra"), "date": ("data_coleta",), "timestamp_ntz": ("ingestion_ts",)}
_TYPE_OF = {name: kind for kind, names in _TYPES.items() for name in names}

ORACLES = {
    "csv_scan": FILE_ROWS_SQL,
    "ingest_batch": FILE_ROWS_SQL,
    "ingest_packed": FILE_ROWS_SQL,
    "ingest_ledger": with_raw("""
        SELECT "partition", 'loaded' AS load_status, count(*) AS n_rows, TIMESTAMP '2025-07-01' AS loaded_at,
          true AS contents_differ
        FROM raw_prices GROUP BY "partition\""""),
    "ingest_archive": ROWS_PER_PARTITION_SQL,
    "rows_per_file": with_raw("""
        SELECT source_file, count("Valor de Compra") AS rows_ingested FROM raw_prices GROUP BY source_file"""),
    "period_rows": with_raw("""
        SELECT * EXCLUDE (source_file, ingestion_ts) FROM raw_prices
        WHERE "partition" = (SELECT max("partition") FROM raw_prices)"""),
    "period_packed": FILE_ROWS_SQL + ' WHERE "partition" = (SELECT max("partition") FROM raw_prices)',
    "partition_layout": f"""
        WITH periods AS (
          SELECT year(o_orderdate) || '-' || CASE WHEN month(o_orderdate) <= 6 THEN '01' ELSE '02' END AS period,
            max(o_orderdate) AS last_day, count(*) AS n_rows
          FROM orders GROUP BY 1)
        SELECT period, '{SOURCE.name}/partition=' || period || '/{SOURCE.file_prefix}-' || period || '-'
            || strftime(last_day, '%Y-%m-%d_%H%M%S') || '.csv' AS landing_path, n_rows
        FROM periods""",
    "partition_from_path": with_raw("""
        SELECT split_part(split_part(source_file, 'partition=', 2), '/', 1) AS from_path, "partition",
          count(*) AS n_rows
        FROM raw_prices GROUP BY ALL"""),
    "semester_fallback": """
        WITH counts AS (
          SELECT year(l_shipdate) * 2 + CASE WHEN month(l_shipdate) <= 6 THEN 0 ELSE 1 END AS p, count(*) AS n_rows
          FROM lineitem GROUP BY 1),
        asked AS (
          SELECT DISTINCT year(o_orderdate) * 2 + CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS w
          FROM orders),
        found AS (
          SELECT w, CASE WHEN w IN (SELECT p FROM counts) THEN w WHEN w - 1 IN (SELECT p FROM counts) THEN w - 1 END
            AS r
          FROM asked)
        SELECT (w // 2) || '-0' || (w % 2 + 1) AS wanted, (r // 2) || '-0' || (r % 2 + 1) AS resolved, n_rows
        FROM found LEFT JOIN counts ON r = p""",
    "content_checksum": """
        SELECT 'document' AS kind, doc_id AS id, sha256(text) AS file_checksum FROM documents
        UNION ALL SELECT 'page', page_id, sha256(html) FROM pages""",
    "file_sizes": """
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS size_bytes, round_even(strlen(html) / 1024, 1) AS size_kb
        FROM pages""",
    "ledger_build": _FILES_SQL
    + """SELECT source_file, TIMESTAMP '2025-07-01' AS ingestion_ts, rows_ingested, file_checksum,
           'loaded' AS load_status FROM known""",
    "ledger_skip_anti": _FILES_SQL
    + """SELECT min(source_file) AS source_file, arg_min(rows_ingested, source_file) AS rows_ingested, file_checksum
         FROM files WHERE file_checksum NOT IN (SELECT file_checksum FROM known) GROUP BY file_checksum""",
    "ledger_known_semi": _FILES_SQL
    + "SELECT source_file, file_checksum FROM files WHERE file_checksum IN (SELECT file_checksum FROM known)",
    "ledger_name_conflict": _FILES_SQL
    + """SELECT source_file, sha256(file_checksum || source_file) AS file_checksum
         FROM files WHERE source_file IN (SELECT source_file FROM known)""",
    "table_exists": with_raw("""
        SELECT "partition", count(*) AS n_rows, true AS present, false AS absent
        FROM raw_prices GROUP BY "partition\""""),
    "contract_describe": with_model(
        " UNION ALL ".join(
            f"""SELECT {i} AS position, '{c.name}' AS column_name, '{_TYPE_OF.get(c.name, "string")}' AS data_type,
            true AS has_comment, count("{c.name}") AS non_null_rows FROM model"""
            for i, c in enumerate(MODEL.columns, 1)
        )
    ),
}
