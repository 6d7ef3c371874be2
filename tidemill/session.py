"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, ANSI casts and adaptive execution; ``conf`` wins over the defaults.

    Shuffle partitions are left to the cluster: adaptive execution merges small ones
    down to the advisory size, so a large job only needs a high enough start value.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
