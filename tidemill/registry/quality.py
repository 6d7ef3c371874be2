"""Data-quality checks on clean and on dirty input, and freshness."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.operators import ledger, quality
from tidemill.operators.check_states import run_stored_checks
from tidemill.plans.fuel_prices import MODEL, MODEL_KEY, PRODUCT, REGIONS, SOURCE, STATES
from tidemill.plans.staging import clean, full_model
from tidemill.plans.warehouse import Warehouse
from tidemill.registry.raw_prices import raw_prices, table, with_clean, with_model, with_raw
from tidemill.storage import scratch_dir


def _model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_model(raw_prices(spark, sf_dir), MODEL)


def _shared_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as ledger rows under names and contents that several of them share."""
    return table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", "lang", F.col("n_chars").cast("string")).alias("source_file"),
        F.size(F.split("text", "\n")).cast("long").alias("rows_ingested"),
        F.sha2("text", 256).alias("file_checksum"),
    )


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [c for c in MODEL.checks if c.kind == "not_null"]
    model = quality.run_checks(_model(spark, sf_dir), checks).select("column_name", "failing_rows")
    required = ledger.missing_required(_shared_names(spark, sf_dir))
    return model.withColumn("table_name", F.lit("model")).unionByName(
        required.withColumn("table_name", F.lit("ledger"))
    )


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failing_rows(clean(raw_prices(spark, sf_dir), MODEL), quality.unique(MODEL_KEY))


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        quality.accepted_values("Regiao - Sigla", REGIONS),
        quality.accepted_values("Estado - Sigla", STATES),
        quality.accepted_values("Produto", (PRODUCT,)),
    ]
    failing = quality.failing_pairs(raw_prices(spark, sf_dir), checks)
    return failing.groupBy("value", "column_name").agg(F.count("*").alias("n_rows"))


def dq_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [quality.match_regex("CNPJ da Revenda", "^[0-9]+$"), quality.match_regex("Cep", "^[0-9]*$")]
    return quality.failing_pairs(raw_prices(spark, sf_dir), checks, "source_file", "ingestion_ts")


def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postal codes of the model and company numbers as printed that have another length."""
    raw = raw_prices(spark, sf_dir)
    checks = [
        (full_model(raw, MODEL), quality.length_equals("cep", 8)),
        (raw, quality.length_equals("CNPJ da Revenda", 14)),
    ]
    parts = [quality.failing_pairs(df, [c], "source_file", "ingestion_ts") for df, c in checks]
    return parts[0].unionByName(parts[1])


def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        quality.between("valor_venda", low=0),
        quality.between("valor_compra", low=0),
        quality.between("valor_venda", low=5000, high=50000),
    ]
    report = quality.run_checks(_model(spark, sf_dir), checks)
    return report.select("column_name", "failing_rows", "status")


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole suite over the stored model, so that its scans read only the checked columns."""
    stored = Warehouse(scratch_dir(spark, "report")).model_table(MODEL)
    stored.replace(clean(raw_prices(spark, sf_dir), MODEL), mark=1)
    return quality.run_checks(stored.read(spark), MODEL.checks)


def dq_report_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite from the states of slices: made for a first load, and again for what an upsert of the rest rewrote."""
    stored = Warehouse(scratch_dir(spark, "report-states")).model_table(MODEL)
    rows, late = raw_prices(spark, sf_dir), F.col("partition") >= "2000-01"
    stored.replace(clean(rows.where(~late), MODEL), mark=1)
    run_stored_checks(spark, stored, MODEL.checks).collect()
    stored.merge(clean(rows.where(late), MODEL), mark=2)
    return run_stored_checks(spark, stored, MODEL.checks)


def dq_ledger_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.duplicate_names(_shared_names(spark, sf_dir))


def dq_ledger_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.duplicate_checksums(_shared_names(spark, sf_dir))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By every row's load time, and by the ledger of hourly files of the same events, which has a row per file."""
    moments = [datetime(2024, 6, 1), datetime(2024, 7, 31), datetime(2024, 8, 15)]
    events = table(spark, sf_dir, "events")
    entries = events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count("*").alias("rows_ingested"), F.max("ts").alias("ingestion_ts")
    )
    limits = moments, SOURCE.warn_after_days, SOURCE.error_after_days
    by_row = quality.freshness(events, "ts", *limits).withColumn("source", F.lit("rows"))
    by_ledger = quality.freshness(ledger.loads_with_rows(entries), "ingestion_ts", *limits)
    return by_row.unionByName(by_ledger.withColumn("source", F.lit("ledger")))


QUERIES = {
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_regex": dq_regex,
    "dq_length": dq_length,
    "dq_between": dq_between,
    "dq_report": dq_report,
    "dq_report_stored": dq_report_stored,
    "dq_ledger_pk": dq_ledger_pk,
    "dq_ledger_checksum": dq_ledger_checksum,
    "freshness": freshness,
}

_NOT_NULL = (
    MODEL_KEY, "regiao_sigla", "estado_sigla", "municipio", "cnpj_revenda", "data_coleta", "valor_venda",
    "bandeira", "partition", "source_file",
)
_STATES_SQL = ", ".join(f"'{s}'" for s in STATES)
_REGIONS_SQL = ", ".join(f"'{r}'" for r in REGIONS)


def _failures(column: str, check: str, predicate: str) -> str:
    return f"""SELECT '{column}' AS column_name, '{check}' AS check_name,
        count(*) FILTER (WHERE {predicate}) AS failures, count(*) FILTER (WHERE {predicate}) AS failing_rows
        FROM model"""


def _rejected(column: str, values: str) -> str:
    return f"""SELECT '{column}' AS column_name, 'accepted_values' AS check_name,
        count(DISTINCT {column}) FILTER (WHERE {column} NOT IN ({values})) AS failures,
        count(*) FILTER (WHERE {column} NOT IN ({values})) AS failing_rows
        FROM model"""


_REPORT_SQL = " UNION ALL ".join(
    [_failures(c, "not_null", f'"{c}" IS NULL') for c in _NOT_NULL]
    + [
        _failures("cnpj_revenda", "match_regex", "NOT regexp_matches(cnpj_revenda, '^[0-9]+$')"),
        _failures("cep", "match_regex", "NOT regexp_matches(cep, '^[0-9]*$')"),
        _failures("cnpj_revenda", "length_equals", "length(cnpj_revenda) <> 14"),
        _failures("cep", "length_equals", "length(cep) <> 8"),
        _failures("valor_venda", "between", "valor_venda < 0"),
        _failures("valor_compra", "between", "valor_compra < 0"),
        _rejected("regiao_sigla", _REGIONS_SQL),
        _rejected("estado_sigla", _STATES_SQL),
        _rejected("produto", "'GLP'"),
        """SELECT 'sk_revenda_coleta' AS column_name, 'unique' AS check_name, count(*) AS failures,
             CAST(coalesce(sum(n), 0) AS BIGINT) AS failing_rows
           FROM (SELECT count(*) AS n FROM model GROUP BY sk_revenda_coleta HAVING count(*) > 1)""",
    ]
)

_SHARED_SQL = """
    WITH shared AS (
      SELECT source || '/' || lang || '/' || CAST(n_chars AS VARCHAR) AS source_file,
        length(text) - length(replace(text, chr(10), '')) + 1 AS rows_ingested, sha256(text) AS file_checksum
      FROM documents)
"""

_REPORT_LINES_SQL = with_model(f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({_REPORT_SQL})")

ORACLES = {
    "dq_not_null": with_model(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS failing_rows,"
            " 'model' AS table_name FROM model"
            for c in _NOT_NULL
        )
        + """
        UNION ALL SELECT 'source_file', count(*) FILTER (WHERE source || lang || n_chars IS NULL), 'ledger'
        FROM documents
        UNION ALL SELECT 'rows_ingested', count(*) FILTER (WHERE text IS NULL), 'ledger' FROM documents
        UNION ALL SELECT 'file_checksum', count(*) FILTER (WHERE text IS NULL), 'ledger' FROM documents"""
    ),
    "dq_unique": with_clean("""
        SELECT sk_revenda_coleta AS value, count(*) AS n_rows FROM cleaned
        GROUP BY sk_revenda_coleta HAVING count(*) > 1"""),
    "dq_accepted_values": with_raw(f"""
        SELECT "Regiao - Sigla" AS value, count(*) AS n_rows, 'Regiao - Sigla' AS column_name
        FROM raw_prices WHERE "Regiao - Sigla" NOT IN ({_REGIONS_SQL}) GROUP BY 1
        UNION ALL
        SELECT "Estado - Sigla", count(*), 'Estado - Sigla'
        FROM raw_prices WHERE "Estado - Sigla" NOT IN ({_STATES_SQL}) GROUP BY 1
        UNION ALL
        SELECT "Produto", count(*), 'Produto' FROM raw_prices WHERE "Produto" NOT IN ('GLP') GROUP BY 1"""),
    "dq_regex": with_raw("""
        SELECT 'CNPJ da Revenda' AS column_name, "CNPJ da Revenda" AS value, source_file, ingestion_ts
        FROM raw_prices WHERE NOT regexp_matches("CNPJ da Revenda", '^[0-9]+$')
        UNION ALL
        SELECT 'Cep', "Cep", source_file, ingestion_ts
        FROM raw_prices WHERE NOT regexp_matches("Cep", '^[0-9]*$')"""),
    "dq_length": with_model("""
        SELECT 'cep' AS column_name, cep AS value, source_file, ingestion_ts FROM model WHERE length(cep) <> 8
        UNION ALL
        SELECT 'CNPJ da Revenda', "CNPJ da Revenda", source_file, ingestion_ts
        FROM raw_prices WHERE length("CNPJ da Revenda") <> 14"""),
    "dq_between": with_model("""
        SELECT column_name, failing_rows, CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
          SELECT 'valor_venda' AS column_name, count(*) FILTER (WHERE valor_venda < 0) AS failing_rows FROM model
          UNION ALL SELECT 'valor_compra', count(*) FILTER (WHERE valor_compra < 0) FROM model
          UNION ALL SELECT 'valor_venda', count(*) FILTER (WHERE valor_venda < 5000 OR valor_venda > 50000)
          FROM model)"""),
    "dq_report": _REPORT_LINES_SQL,
    "dq_report_stored": _REPORT_LINES_SQL,
    "dq_ledger_pk": _SHARED_SQL
    + "SELECT source_file AS value, count(*) AS n_rows FROM shared GROUP BY 1 HAVING count(*) > 1",
    "dq_ledger_checksum": _SHARED_SQL
    + "SELECT file_checksum AS value, count(*) AS n_rows FROM shared GROUP BY 1 HAVING count(*) > 1",
    "freshness": """
        SELECT as_of, newest, source,
          CASE WHEN newest IS NULL OR as_of - newest > INTERVAL 190 DAY THEN 'error'
               WHEN as_of - newest > INTERVAL 180 DAY THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max(ts) AS newest FROM events),
          (VALUES (TIMESTAMP '2024-06-01'), (TIMESTAMP '2024-07-31'), (TIMESTAMP '2024-08-15')) AS moments(as_of),
          (VALUES ('rows'), ('ledger')) AS sources(source)""",
}
