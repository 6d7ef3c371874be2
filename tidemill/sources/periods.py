"""Which half-year to read when the wanted one may not be published yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions import previous_period


def resolve_periods(wanted: DataFrame, available: DataFrame) -> DataFrame:
    """``wanted, resolved``: the wanted period, else the one before it, else NULL.

    ``wanted`` has a column of that name and ``available`` a column ``partition``, once per period
    if it has others too; those follow the resolved period. Exactly
    one step back is tried. Both sides are period lists, a few rows per year of data.
    """
    more = [c for c in available.columns if c != "partition"]
    asked = wanted.select("wanted").distinct()
    steps = F.array(
        F.struct(F.lit(0).alias("step"), F.col("wanted").alias("candidate")),
        F.struct(F.lit(1).alias("step"), previous_period("wanted").alias("candidate")),
    )
    tried = asked.select("wanted", F.inline(steps))
    present = available if more else available.distinct()
    found = tried.join(present, F.col("candidate") == F.col("partition"), "left")
    step_found = F.when(F.col("partition").isNotNull(), F.col("step"))
    best = F.min_by(F.struct(F.col("partition").alias("resolved"), *more), step_found).alias("best")
    return found.groupBy("wanted").agg(best).select("wanted", "best.*")


def rows_of_period(table: DataFrame, wanted: str, available: DataFrame | None = None) -> DataFrame:
    """Rows of the wanted half-year or, when it has none, of the one before it.

    Reads one partition of a table partitioned by ``partition``. ``available`` names the
    half-years present, for tables that know them without a scan (``Warehouse.periods``).
    Neither present is an error.
    """
    spark = table.sparkSession
    asked = spark.createDataFrame([(wanted,)], "wanted string")
    present = table.select("partition") if available is None else available
    resolved = resolve_periods(asked, present).first()["resolved"]
    if resolved is None:
        raise FileNotFoundError(f"no rows for {wanted} nor for the half-year before it")
    return table.where(F.col("partition") == resolved)
