"""What several operators share: tables, stored steps, per-process memory, linked groups."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.storage import scratch_dir, scratch_released

#: Words of the contracts: runs without blanks and ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that pass to a Python worker at once where the session leaves Spark's default: texts are long, and batches are held
#: several times over, in the JVM and in the worker.
ROWS_AT_ONCE = 1500


def small_batches(spark: SparkSession) -> None:
    """Keep the memory of Python steps low in this session, unless it has a batch size of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(ROWS_AT_ONCE))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(spark: SparkSession, df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written below the shared folder and read back: the plan ends there, and lost executors lose nothing."""
    small_batches(spark)
    path = scratch_dir(spark, label) + "/data"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(spark: SparkSession, step: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``step`` gives, stored; the tables that it stored on its way are deleted."""
    small_batches(spark)
    path = scratch_dir(spark, label) + "/data"
    with scratch_released(spark):
        df = step()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def process_memory(name: str) -> dict:
    """A dictionary that outlives a task in its Python worker, until another operator's task runs there."""
    held = vars(sys).setdefault("_tidemill_llm", {})
    if name not in held:
        held.clear()
    return held.setdefault(name, {})


def connected_components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node of the links, the component being its smallest node.

    Alternates the large-star and small-star steps: every step keeps the components,
    replaces links by links to smaller nodes, and ends when each node points at its
    smallest. All steps are partial aggregates and joins on nodes; a hub's links are
    spread by adaptive skew joins, and no group is ever gathered. Each round is stored,
    so a lost executor repeats one round at most. Null ends and self-links count for
    nothing; repeated links count once.
    """
    pairs = stored(
        spark,
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(),
        "links",
    )
    before = None
    while True:
        both = pairs.union(pairs.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        pairs = stored(spark, moved.union(low).distinct(), "links")
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
