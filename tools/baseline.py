"""Times what the headline queries do, step by step and through files, on one DuckDB thread.

    python tools/baseline.py [sf_dir] [threads]

The steps are those of the Spark queries: raw rows written and read again, files hashed before they are loaded, a ledger
written last, the model stored, merged and checked from its files. Prints the median of three runs after a warm-up.
"""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidemill.registry import all_oracles  # noqa: E402
from tidemill.registry.quality import _REPORT_SQL  # noqa: E402
from tidemill.registry.raw_prices import CLEAN_SQL, MODEL_SQL, TIES, with_model, with_raw  # noqa: E402

TABLES = "region nation supplier part orders lineitem events documents pages labels".split()
LATE = "regexp_matches(source_file, '/part-[5-9]\\.csv$')"


def model_of(source: str, where: str = "true") -> str:
    rows = f"raw_prices AS (SELECT * FROM {source} WHERE {where})"
    return f"WITH {rows},{CLEAN_SQL},{MODEL_SQL} SELECT * FROM model"


def stored_model(con: duckdb.DuckDBPyConnection, place: str) -> str:
    """The model as files, one folder per half-year."""
    con.execute(f"COPY ({with_model('SELECT * FROM model')}) TO '{place}/model' (FORMAT parquet, PARTITION_BY (\"partition\"))")
    return f"read_parquet('{place}/model/*/*.parquet', hive_partitioning = true, hive_types_autocast = false)"


def upsert(con: duckdb.DuckDBPyConnection, place: str) -> None:
    con.execute(f"COPY ({with_raw(f'SELECT *, {LATE} AS late FROM raw_prices')}) TO '{place}/raw' (FORMAT parquet, PARTITION_BY (late))")
    raw = f"(SELECT * EXCLUDE (late) FROM read_parquet('{place}/raw/late=%s/*.parquet', hive_partitioning = true))"
    con.execute(f"COPY ({model_of(raw % 'false')}) TO '{place}/v1' (FORMAT parquet, PARTITION_BY (\"partition\"))")
    both = f"""SELECT * FROM read_parquet('{place}/v1/*/*.parquet', hive_partitioning = true, hive_types_autocast = false)
               UNION ALL BY NAME ({model_of(raw % 'true')})"""
    newest = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sk_revenda_coleta ORDER BY {TIES}) AS rn
                 FROM ({both})) WHERE rn = 1"""
    con.execute(f"COPY ({newest}) TO '{place}/v2' (FORMAT parquet, PARTITION_BY (\"partition\"))")
    con.execute(f"CREATE OR REPLACE TEMP TABLE out AS SELECT * FROM read_parquet('{place}/v2/*/*.parquet', hive_partitioning = true)")


def report(con: duckdb.DuckDBPyConnection, place: str) -> None:
    con.execute(f"CREATE OR REPLACE TEMP TABLE out AS WITH model AS (SELECT * FROM {stored_model(con, place)}) {_REPORT_SQL}")


def ingest(con: duckdb.DuckDBPyConnection, place: str, pieces: int = 1) -> None:
    con.execute(f"COPY ({all_oracles()['csv_scan']}) TO '{place}/in' (FORMAT csv, HEADER, DELIMITER ';', PARTITION_BY (\"partition\"))")
    con.execute("CREATE OR REPLACE TABLE ledger (name VARCHAR, checksum VARCHAR, n BIGINT)")
    names = [r[0] for r in con.execute(f"SELECT file FROM glob('{place}/in/*/*.csv') ORDER BY file").fetchall()]
    for run in range(2):  # the second finds every content known
        for p in range(pieces):
            some = names[p::pieces]
            con.execute(f"CREATE OR REPLACE TEMP TABLE found AS SELECT filename, sha256(content) AS checksum FROM read_blob({some})")
            con.execute("DELETE FROM found WHERE checksum IN (SELECT checksum FROM ledger)")
            new = [r[0] for r in con.execute("SELECT filename FROM found").fetchall()]
            if not new:
                continue
            rows = f"read_csv({new}, delim = ';', header = true, all_varchar = true, filename = true, hive_partitioning = true, hive_types_autocast = false)"
            con.execute(f"COPY (SELECT * FROM {rows}) TO '{place}/raw-{run}-{p}' (FORMAT parquet, PARTITION_BY (\"partition\"))")
            con.execute(
                f"""INSERT INTO ledger SELECT filename, any_value(checksum), count(*)
                    FROM read_parquet('{place}/raw-{run}-{p}/*/*.parquet') JOIN found USING (filename) GROUP BY filename"""
            )
    con.execute(f"CREATE OR REPLACE TEMP TABLE out AS SELECT * FROM read_parquet('{place}/raw-*/*/*.parquet', hive_partitioning = true)")


def plain(name: str) -> Callable[[duckdb.DuckDBPyConnection, str], object]:
    return lambda con, place: con.execute(f"CREATE OR REPLACE TEMP TABLE out AS {all_oracles()[name]}")


STEPS = {
    "stg_full_refresh": plain("stg_full_refresh"),
    "incremental_upsert": upsert,
    "latest_per_key": plain("latest_per_key"),
    "events_latest": plain("events_latest"),
    "dq_report": report,
    "ingest_batch": ingest,
    "stream_ingest_once": lambda con, place: ingest(con, place, 4),
    "stream_events_latest": plain("stream_events_latest"),
    "content_checksum": plain("content_checksum"),
    "ledger_skip_anti": plain("ledger_skip_anti"),
    "semester_fallback": plain("semester_fallback"),
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    con = duckdb.connect(config={"threads": threads})
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    total = 0.0
    for name, steps in STEPS.items():
        taken = []
        for _ in range(4):
            place = tempfile.mkdtemp(prefix="baseline-")
            start = time.perf_counter()
            steps(con, place)
            taken.append(time.perf_counter() - start)
        total += statistics.median(taken[1:])
        print(f"{name:22} {statistics.median(taken[1:]):6.2f}", flush=True)
    print(f"{'sum':22} {total:6.2f}")


if __name__ == "__main__":
    main()
