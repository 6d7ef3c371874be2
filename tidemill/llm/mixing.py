"""Mixing sources to target weights by weighted sampling without replacement.

Sources ask for shares of the mix by weight, up to ``most`` times their own size. Every
document draws an exponential key at the rate of its quality weight (Efraimidis and
Spirakis); sorted by key, a source's prefix is a sample without replacement in which better
documents come first. A source whose target exceeds its size is taken whole as
often as it fits, and only the rest is a prefix, cut where its word sum is nearest.

The prefix sum of a source never runs in one task: keys fall into ``CELLS`` ordered
cells, even in the logarithm, so that no weight crowds a cell: one holds about a four-thousandth of its source at
most. Their sums are partial aggregates; the running sum over cells finds the one cell
in which the cut lies, and only that cell's documents are sorted.

Defined results: a null text has size 0, empty texts too; they are taken with 0 words. A
null source is a source of its own, last in order. Keys depend on ``doc_id`` and text, so
reruns agree and rows without ``doc_id`` or of one differ by text; only rows that repeat both draw the same key and are taken alike. A source
without words is not in the mix. With no words at all, targets are 0. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemill.llm.common import WORD, stored, stored_alone, table, text_of

CELLS = 1 << 16
#: Logarithms of the least and the greatest key that 52 bits and a weight of 0.1 can give.
LOG_KEYS = (-37.0, 6.0)
#: Sources up to which their table (a hundred bytes each) is sent to all tasks; beyond, it is joined.
BROADCAST_SOURCES = 100_000
#: Signs that prose has few of; their share lowers a document's quality weight.
SIGNS = "#$%&*!|<>{}[]=+^~@/_0123456789"


def quality_weight() -> Column:
    """Between 0.1 and 1: the fourth power of the share of characters that are not signs."""
    text = text_of()
    clean = F.length(F.translate(text, SIGNS, "")) / F.greatest(F.length(text), F.lit(1))
    return 0.1 + 0.9 * clean * clean * clean * clean


def draw(seed: str, quality: Column) -> Column:
    """An exponential key at rate ``quality``, from the document's id and text."""
    own = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text_of()))
    bits = F.substring(F.md5(own), 1, 13)
    uniform = (F.conv(bits, 16, 10).cast("long") + 1) / F.lit(4503599627370497.0)
    return -F.log(uniform) / quality


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source, source_size, target``; one row per source.

    Sharing the excess again until no source is above its limit ends at
    ``least(limit, rate * weight)`` for one common rate. With sources sorted by limit over
    weight, the rate is the first that the sources after it can all bear. The table has
    a row per source, so its global order is small work.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    wanted = F.array(*[F.lit(float(w)) for w in weights])
    sizes = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(wanted, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
        .withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    )
    everything = Window.partitionBy()
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rated = sizes.withColumn(
        "rate",
        (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))),
    )
    rated = rated.withColumn("place", F.row_number().over(by_limit))
    bearable = F.when(F.col("rate") * F.col("weight") <= F.col("limit"), F.struct("place", "rate"))
    first = F.min(bearable).over(everything)["rate"]
    return rated.select(
        "source",
        "source_size",
        F.coalesce(F.least("limit", first * F.col("weight")), F.col("limit")).alias("target"),
    )


def keyed(docs: DataFrame, seed: str) -> DataFrame:
    """A row per document: all of it as ``doc``, its source, exponential key, and the key's cell."""
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col("source"), draw(seed, quality_weight()).alias("key"), text_of().alias("text")
    )
    place = F.floor((F.log("key") - LOG_KEYS[0]) / (LOG_KEYS[1] - LOG_KEYS[0]) * CELLS)
    cell = F.least(F.lit(CELLS - 1), F.greatest(F.lit(0), place)).cast("int")
    return rows.select("doc", "source", "key", cell.alias("cell"), "text")


def source_cuts(
    spark: SparkSession, sized: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """``its_source, source_size, target, whole, cut_cell, cut_key``: a row per source, from ``source, size, key, cell, doc_id``.

    The mix takes a source's documents ``whole`` times, and once more those of cells before ``cut_cell`` and those of
    that cell with keys up to ``cut_key``.
    """
    whole = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    targets = (
        source_targets(sized, weights, share, most)
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "its_source")
    )
    targets = stored(spark, targets, "targets")
    up_to = Window.partitionBy("source").orderBy("cell")
    cells = (
        sized.groupBy("source", "cell")
        .agg(F.sum("size").alias("cell_size"))
        .withColumn("before", F.sum("cell_size").over(up_to) - F.col("cell_size"))
    )
    cut_cells = stored(
        spark,
        cells.join(targets, F.col("source").eqNullSafe(F.col("its_source")))
        .where("rest > 0 and before <= rest and rest < before + cell_size")
        .select(F.col("source").alias("cut_source"), F.col("cell").alias("cut_cell"), "before", "rest"),
        "cells",
    )
    by_key = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    cut_keys = (
        sized.join(cut_cells, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("cell") == F.col("cut_cell")))
        .withColumn("middle", F.col("before") + F.sum("size").over(by_key) - F.col("size") / 2)
        .where("middle <= rest")
        .groupBy(F.col("source").alias("key_source"))
        .agg(F.max("key").alias("cut_key"))
    )
    return stored(
        spark,
        targets.join(cut_cells.drop("before", "rest"), F.col("its_source").eqNullSafe(F.col("cut_source")), "left")
        .join(cut_keys, F.col("its_source").eqNullSafe(F.col("key_source")), "left")
        .select("its_source", "source_size", "target", "whole", "cut_cell", "cut_key"),
        "cuts",
    )


def decided(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` of ``source, key, cell`` with their source's numbers and ``repeats``."""
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    more = (F.col("cell") < F.col("cut_cell")) | ((F.col("cell") == F.col("cut_cell")) & (F.col("key") <= F.col("cut_key")))
    joined = rows.join(cuts, F.col("source").eqNullSafe(F.col("its_source")))
    return joined.withColumn("repeats", (F.col("whole") + F.when(more, 1).otherwise(0)).cast("int"))


def _sized(spark: SparkSession, docs: DataFrame, seed: str) -> DataFrame:
    size = F.regexp_count("text", F.lit(WORD)).cast("long")
    return stored(
        spark,
        keyed(docs.select("doc_id", "source", "text"), seed).select("doc.doc_id", "source", size.alias("size"), "key", "cell"),
        "sizes",
    )


def mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, repeats, taken`` of every row.

    ``repeats`` is how often the mix takes the document, ``taken`` its words in the mix.
    Weights belong to sources in code point order and repeat.
    """
    sized = _sized(spark, docs, seed)
    return decided(sized, source_cuts(spark, sized, weights, share, most)).select(
        "doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken")
    )


def mixed_documents(
    spark: SparkSession,
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself: ``docs`` with all columns, each row as often as it is taken.

    Keys are drawn again from the rows, so texts meet only the table of sources and are not shuffled.
    """
    cuts = stored_alone(spark, lambda: source_cuts(spark, _sized(spark, docs, seed), weights, share, most), "cuts")
    rows = decided(keyed(docs, seed).drop("text"), cuts)
    return rows.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("repeats")))).select("doc.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op8_mixing": op8_mixing}

ORACLES = {
    "op8_mixing": rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         length(translate(coalesce(text, ''), '{SIGNS}', '')) / greatest(length(coalesce(text, '')), 1)::DOUBLE AS clean
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(t)), 1, 13))::BIGINT + 1) / 4503599627370497.0::DOUBLE)
           / (0.1::DOUBLE + 0.9::DOUBLE * clean * clean * clean * clean) AS key
  FROM sized),
sources AS (SELECT source, sum(size)::DOUBLE AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS top,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sources),
rated AS (
  SELECT *, row_number() OVER (ORDER BY top / weight, source NULLS LAST) AS place, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(top) OVER w, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS rate
  FROM weighed
  WINDOW w AS (ORDER BY top / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         coalesce(least(top, arg_min(rate, place) FILTER (rate * weight <= top) OVER () * weight), top) AS target
  FROM rated),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
summed AS (
  SELECT doc_id, size, e.source_size, e.target, e.whole,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0::DOUBLE AS middle
  FROM keyed k JOIN epochs e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN middle <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed""",
}
