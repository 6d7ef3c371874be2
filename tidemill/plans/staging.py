"""From the raw table to the model: filter, clean, key, keep the newest row per key."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tidemill.contracts import ModelContract, SourceContract
from tidemill.operators.latest import latest_per_key, newest_first
from tidemill.plans.warehouse import Warehouse
from tidemill.storage import Lease, exclusive


def clean(raw: DataFrame, model: ModelContract) -> DataFrame:
    """Kept raw rows, renamed, cleaned and typed."""
    columns = [c.value().alias(c.name, metadata={"comment": c.comment}) for c in model.columns]
    return raw.where(model.keep()).select(*columns)


def full_model(raw: DataFrame, model: ModelContract) -> DataFrame:
    return latest_per_key(clean(raw, model), model.key, newest_first(model.tie_order))


def build_model(
    spark: SparkSession,
    source: SourceContract,
    model: ModelContract,
    warehouse: Warehouse,
    full_refresh: bool = False,
    rescan: bool = False,
) -> DataFrame:
    """Bring the stored model up to the last committed raw batch and return it.

    The first run and a full refresh build it whole. Later runs read only raw batches
    the model has not seen and rewrite only the half-years these touch; keeping the
    newest of newest rows gives the same table as ``rescan``, which reads all raw rows.
    A second writer of the same warehouse fails.
    """
    with exclusive(spark, warehouse.lease_path(model.table)) as lease:
        _build(spark, source, model, warehouse, full_refresh, rescan, lease)
    return warehouse.model_table(model).read(spark)


def _build(
    spark: SparkSession,
    source: SourceContract,
    model: ModelContract,
    warehouse: Warehouse,
    full_refresh: bool,
    rescan: bool,
    lease: Lease,
) -> None:
    table = replace(warehouse.model_table(model), run=lease.token)
    last = warehouse.committed_batch(spark, source)
    seen = table.mark(spark)
    lease.check()
    if seen is None or full_refresh:
        table.replace(clean(warehouse.read_raw(spark, source), model), last, stored=True)
    elif rescan or seen < last:
        raw = warehouse.read_raw(spark, source, after=0 if rescan else seen)
        table.merge(clean(raw, model), last, stored=True)


def compact_model(spark: SparkSession, model: ModelContract, warehouse: Warehouse) -> None:
    """Fold the model's deltas into its slices. A second writer fails."""
    with exclusive(spark, warehouse.lease_path(model.table)) as lease:
        lease.check()
        replace(warehouse.model_table(model), run=lease.token).compact(spark)
