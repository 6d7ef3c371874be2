"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Bits that name the word a key's mark lies in: a million words of 64 marks, some 50 MB where all are broadcast.
WORD_BITS = 20


def newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.desc(c) for c in columns]


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key under ``order``.

    The ``= 1`` filter lets Spark keep one row per key in every map task before the
    shuffle, so a key that holds a third of all rows reaches its reducer as at most one
    row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def latest_of_stored(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``latest_per_key`` of rows that lie in files: only rows of repeated keys are moved, the others stay in the task that reads them.

    For frames that give the same rows whenever they are read: they are read three times, at first the key alone. Hashes
    of keys that come more than once leave marks in ``2 ** WORD_BITS`` words of 64 bits. A row without a mark
    is the only one of its key; of those with a mark the newest are kept, and a mark that is another key's costs a
    row's way through the shuffle and nothing else. With as many repeated keys as marks most rows are moved.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def word(place: Column) -> Column:
        return F.shiftrightunsigned(place, 64 - WORD_BITS)

    def bit(place: Column) -> Column:
        return place.bitwiseAND(F.lit(63)).cast("int")

    def is_marked(place: Column) -> Column:
        return F.coalesce(F.getbit("_marks", bit(place)), F.lit(0)) == 1

    own, place = F.xxhash64(*keys), F.col("_place")
    repeated = df.groupBy(own.alias("_place")).agg(F.count("*").alias("_rows")).where("_rows > 1")
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), bit(place))
    marks = F.broadcast(repeated.groupBy(word(place).alias("_word")).agg(F.bit_or(mark).alias("_marks")))
    # Spark takes a semi join below the columns it does not need, so they are made of the rows that are moved only.
    moved = df.join(marks, (word(own) == F.col("_word")) & is_marked(own), "left_semi")
    placed = df.withColumn("_place", own).join(marks, word(place) == F.col("_word"), "left")
    alone = placed.where(~is_marked(place)).select(*[F.col(f"`{n}`") for n in df.columns])
    return alone.union(latest_per_key(moved, key, order))
