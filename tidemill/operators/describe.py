"""Columns of a table with the descriptions they carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def describe_columns(df: DataFrame) -> DataFrame:
    """``position, column_name, data_type, comment, non_null_rows``, counted in one scan."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    lines = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.metadata.get("comment")).alias("comment"),
            F.col(f"c{i}").alias("non_null_rows"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*lines)))
