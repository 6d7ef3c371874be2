"""Declarations of a source, of the model built from it, and of the checks on that model."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, types as T

from tidemill.operators.quality import Check


@dataclass(frozen=True)
class SourceColumn:
    name: str
    comment: str


@dataclass(frozen=True)
class SourceContract:
    """Files of one source: their header, their dialect, and how old the newest load may be.

    ``multi_line`` allows line ends inside quotes; a file is then read by one task.
    """

    name: str
    table: str
    file_prefix: str
    columns: tuple[SourceColumn, ...]
    date_format: str = "dd/MM/yyyy"
    csv_options: dict[str, str] = field(default_factory=dict)
    multi_line: bool = False
    file_glob: str = "*.csv"
    loaded_at: str = "ingestion_ts"
    warn_after_days: int = 180
    error_after_days: int = 190

    @property
    def file_schema(self) -> T.StructType:
        """What a file holds: text only, in header order. Typing belongs to the model."""
        return T.StructType(
            [T.StructField(c.name, T.StringType(), True, {"comment": c.comment}) for c in self.columns]
        )

    @property
    def raw_schema(self) -> T.StructType:
        """The raw table: file columns, then where and when each row was loaded from."""
        lineage = [
            T.StructField("partition", T.StringType(), True, {"comment": "Half-year from the landing path."}),
            T.StructField("source_file", T.StringType(), True, {"comment": "File the row was read from."}),
            T.StructField("ingestion_ts", T.TimestampNTZType(), True, {"comment": "Time of the load, UTC."}),
        ]
        return T.StructType([*self.file_schema.fields, *lineage])


@dataclass(frozen=True)
class ModelColumn:
    name: str
    type: T.DataType
    comment: str
    value: Callable[[], Column]


@dataclass(frozen=True)
class ModelContract:
    """One row per key, newest first by ``newest_by`` and then by every other column.

    ``slice_of`` names the storage slice of a row. It must be a function of the key, so
    that an upsert needs to rewrite only the slices its batch touches.
    """

    table: str
    key: str
    columns: tuple[ModelColumn, ...]
    keep: Callable[[], Column]
    newest_by: tuple[str, ...]
    slice_of: Callable[[], Column] | None = None
    checks: tuple[Check, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True, {"comment": c.comment}) for c in self.columns])

    @property
    def tie_order(self) -> list[str]:
        """A total order over rows of one key, so that equal load times leave no choice."""
        rest = [c.name for c in self.columns if c.name not in (self.key, *self.newest_by)]
        return [*self.newest_by, *rest]


def resolve_namespace(custom: str | None, default: str = "") -> str:
    """A custom schema name as given, else the target's; never the two joined."""
    return default if custom is None else custom.strip()
