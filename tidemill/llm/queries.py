"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemill.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    hard_negatives,
    language_id,
    mixing,
    near_dedup,
    periodic_runs,
    secret_scan,
    substring_dedup,
    token_counts,
    token_output,
    toxicity,
)

_PARTS = (
    token_counts,
    decontaminate,
    chat_format,
    near_dedup,
    secret_scan,
    language_id,
    exact_dedup,
    mixing,
    token_output,
    toxicity,
    substring_dedup,
    periodic_runs,
    hard_negatives,
)


def llm_queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def llm_oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
