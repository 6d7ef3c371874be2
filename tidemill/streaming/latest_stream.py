"""Newest row per key over a stream, held in Spark's state store."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.keyed_table import KeyedTable

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ARRIVED = "_arrived"


def changed_rows(rows: DataFrame, table: KeyedTable) -> DataFrame:
    """Of each key whose newest row a micro-batch changes, that row (in update mode).

    The state of a key is its newest row, with the micro-batch in which it arrived; rows of a micro-batch
    are folded per task before the exchange, so a hot key costs one row per task. A row that is older than, or equal
    to, what the state has does not come out again. Ties go by ``tie_order``, then by every other column.
    """
    keys = (table.key,) if isinstance(table.key, str) else table.key
    names = table.schema.names
    others = [n for n in names if n not in table.tie_order]
    arrived = F.col(_ARRIVED)
    order = F.struct(*[F.col(f"`{n}`") for n in (*table.tie_order, *others)], (-F.unix_micros(arrived)).alias("first"))
    newest = F.max_by(F.struct(*[F.col(f"`{n}`") for n in names], arrived), order).alias("newest")
    return (
        rows.select(*[F.col(f"`{n}`") for n in names], F.current_timestamp().alias(_ARRIVED))
        .groupBy(*[F.col(f"`{k}`") for k in keys])
        .agg(newest)
        .where(F.col(f"newest.{_ARRIVED}") == F.current_timestamp())
        .select(*[F.col(f"newest.`{n}`").alias(n) for n in names])
    )


def upsert_stream(rows: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Add the changed rows of each micro-batch to the table as a delta, then stop when the input is used up.

    A micro-batch reads nothing of the table, and one that changes no key writes nothing;
    ``KeyedTable.compact`` is a job of its own. Versions carry the checkpoint's query id, so a micro-batch repeated after
    a failure is added once, and one of another checkpoint is never taken for it. A new checkpoint
    begins with an empty state: it may add rows that the table has in a newer form, which its readers leave out.
    """
    spark = rows.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)  # state beyond the heap

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        writer = uuid.UUID(session.sparkContext.getLocalProperty("sql.streaming.queryId")).hex
        mark = table.mark(session, writer)
        changed = batch.persist()
        try:
            # Counted whole, also when there is nothing to add: the state counts once every part of it was asked for.
            if changed.count() and (mark is None or mark < number):
                table.append(changed, number, writer)
        finally:
            changed.unpersist()

    return (
        changed_rows(rows, table)
        .writeStream.outputMode("update")
        .foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
