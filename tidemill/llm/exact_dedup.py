"""Exact duplicates, with frequent texts taken out of the shuffle.

A Misra-Gries pass (Spark's ``freqItems``, a frequent-items aggregate with
``1 / support`` counters) names every digest that may hold a ``support`` share of the
rows. Their exact counts are taken by partial aggregation; those that hold the share are
at most ``1 / support``, so the winners are broadcast and their rows are decided in the
map tasks. All other digests have few rows each and go through an ordinary shuffle.
Only DataFrame functions are used.

Defined results: a null text counts as empty; empty texts equal each other; equality is
that of SHA-256 over UTF-8, whole texts of any length. Of rows equal in text the largest
``doc_id`` stays; rows that also share that ``doc_id`` all carry ``kept``; a null
``doc_id`` stays only where its group has no other. An empty table gives no rows. Other
columns are never read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemill.llm.common import stored, table, text_of


def exact_dedup(spark: SparkSession, docs: DataFrame, support: float = 0.001) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    digests = stored(
        spark,
        docs.select("doc_id", F.unhex(F.sha2(text_of(), 256)).alias("digest")),
        "digests",
    )
    winners = stored(spark, heavy_digests(digests, support), "winners")
    heavy = digests.join(F.broadcast(winners), "digest")
    alike = Window.partitionBy("digest")
    light = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "digest",
        "doc_id",
        F.max("doc_id").over(alike).alias("keep_id"),
        F.count("*").over(alike).alias("group_size"),
    )
    rows = heavy.select("digest", "doc_id", "keep_id", "group_size").union(light)
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def heavy_digests(digests: DataFrame, support: float) -> DataFrame:
    """``digest, keep_id, group_size`` of the digests with at least ``support`` of all rows: ``1 / support`` at most."""
    keyed = digests.withColumn("short", F.xxhash64("digest"))
    items = keyed.stat.freqItems(["short"], support).select(F.explode("short_freqItems").alias("short")).distinct()
    least = F.ceil(F.lit(support) * digests.count())
    return (
        keyed.join(F.broadcast(items), "short", "left_semi")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where((F.col("group_size") >= least) & (F.col("group_size") > 1))
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op7_exact_dedup": op7_exact_dedup}

ORACLES = {
    "op7_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) AS keep_id,
       count(*) OVER (PARTITION BY sha256(coalesce(text, ''))) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents""",
}
