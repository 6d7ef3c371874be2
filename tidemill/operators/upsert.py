"""Set operations behind a keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tidemill.operators.latest import latest_of_stored, latest_per_key


def union_current_new(current: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both sides, matched by column name rather than by position."""
    return current.unionByName(new)


def untouched(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the batch does not bring."""
    return target.join(batch.select(key), key, "left_anti")


def delete_insert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Replace by key: every batch row wins over the target row of the same key."""
    return union_current_new(untouched(target, batch, key), batch)


def merge_latest(
    current: DataFrame, new: DataFrame, key: str | Sequence[str], order: Sequence[Column], stored: bool = False
) -> DataFrame:
    """Newest row per key over both sides, in one shuffle; of sides that are ``stored`` only rows of repeated keys are moved.

    Equals a delete-and-insert whose batch is the newest row per key of both sides,
    without the extra join.
    """
    latest = latest_of_stored if stored else latest_per_key
    return latest(union_current_new(current, new), key, order)
