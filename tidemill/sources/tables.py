"""Tables by name in the session catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession


def table_exists(spark: SparkSession, namespace: str, table: str) -> bool:
    return spark.catalog.tableExists(f"`{namespace}`.`{table}`")


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    quoted = location.replace("\\", "\\\\").replace("'", "\\'") if location else ""
    at = f" LOCATION '{quoted}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`{at}")
