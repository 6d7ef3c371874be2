"""Every operator as a query over the given tables, with the SQL that must agree with it."""

from __future__ import annotations

from tidemill.registry import cleaning, files, incremental, quality, streams

_PARTS = (cleaning, incremental, quality, files, streams)


def all_queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
