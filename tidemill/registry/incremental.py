"""Appends, unions and upserts. The later files of every half-year play the new batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.operators import upsert
from tidemill.plans.fuel_prices import MODEL, SOURCE
from tidemill.plans.staging import clean, full_model
from tidemill.plans.warehouse import Warehouse
from tidemill.registry.raw_prices import CLEAN_SQL, RAW_SQL, TIES, raw_prices, table, with_model, with_raw
from tidemill.sources import csv_files
from tidemill.storage import scratch_dir, shuffles_released, written_as_they_lie


def _is_new() -> Column:
    return F.col("source_file").rlike(r"/part-[5-9]\.csv\z")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = raw_prices(spark, sf_dir)
    return raw.where(~_is_new()), raw.where(_is_new())


def raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "raw-append")
    for half in _halves(spark, sf_dir):
        half.write.mode("append").partitionBy("partition").parquet(path)
    raw = spark.read.schema(SOURCE.raw_schema).parquet(path)
    return raw.groupBy("partition").agg(
        F.count("*").alias("n_rows"), F.max("ingestion_ts").alias("last_load")
    )


def add_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = csv_files.add_lineage(table(spark, sf_dir, "lineitem"))
    file_name = F.regexp_extract("source_file", r"/([^/]+\.parquet)", 1)
    return rows.groupBy(file_name.alias("file_name")).agg(
        F.count("*").alias("n_rows"), F.count("ingestion_ts").alias("n_stamped")
    )


def empty_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_files.empty_template(spark, SOURCE).unionByName(raw_prices(spark, sf_dir))


def union_current_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _halves(spark, sf_dir)
    return upsert.union_current_new(full_model(old, MODEL), clean(new, MODEL))


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full build from the first raw batch, then an upsert of the second."""
    root = scratch_dir(spark, "upsert")
    batches = raw_prices(spark, sf_dir).withColumn("batch_id", F.when(_is_new(), 2).otherwise(1))
    with written_as_they_lie(spark), shuffles_released(spark):
        batches.write.partitionBy("batch_id").parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    model = Warehouse(root).model_table(MODEL)
    model.replace(clean(raw.where("batch_id = 1"), MODEL), mark=1, stored=True)
    model.merge(clean(raw.where("batch_id = 2"), MODEL), mark=2, stored=True)
    return model.read(spark)


def upsert_untouched(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _halves(spark, sf_dir)
    return upsert.untouched(full_model(old, MODEL), clean(new, MODEL), MODEL.key)


def delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _halves(spark, sf_dir)
    return upsert.delete_insert(full_model(old, MODEL), full_model(new, MODEL), MODEL.key)


QUERIES = {
    "raw_append": raw_append,
    "add_lineage": add_lineage,
    "empty_template": empty_template,
    "union_current_new": union_current_new,
    "incremental_upsert": incremental_upsert,
    "upsert_untouched": upsert_untouched,
    "delete_insert": delete_insert,
}

_HALVES_SQL = f"""WITH {RAW_SQL},{CLEAN_SQL},
  old_rows AS (SELECT * FROM cleaned WHERE NOT regexp_matches(source_file, '/part-[5-9]\\.csv$')),
  new_rows AS (SELECT * FROM cleaned WHERE regexp_matches(source_file, '/part-[5-9]\\.csv$')),
  old_model AS (
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY sk_revenda_coleta ORDER BY {TIES}) AS rn FROM old_rows)
    WHERE rn = 1),
  new_model AS (
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY sk_revenda_coleta ORDER BY {TIES}) AS rn FROM new_rows)
    WHERE rn = 1)
"""

ORACLES = {
    "raw_append": with_raw("""
        SELECT "partition", count(*) AS n_rows, max(ingestion_ts) AS last_load
        FROM raw_prices GROUP BY "partition\""""),
    "add_lineage": """
        SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows, count(*) AS n_stamped FROM lineitem""",
    "empty_template": with_raw("SELECT * FROM raw_prices"),
    "union_current_new": _HALVES_SQL + "SELECT * FROM old_model UNION ALL SELECT * FROM new_rows",
    "incremental_upsert": with_model("SELECT * FROM model"),
    "upsert_untouched": _HALVES_SQL
    + """SELECT * FROM old_model
         WHERE sk_revenda_coleta NOT IN (SELECT sk_revenda_coleta FROM new_rows)""",
    "delete_insert": _HALVES_SQL
    + """SELECT * FROM old_model WHERE sk_revenda_coleta NOT IN (SELECT sk_revenda_coleta FROM new_model)
         UNION ALL SELECT * FROM new_model""",
}
