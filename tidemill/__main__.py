"""Jobs for spark-submit or a scheduler: ``python -m tidemill <job> --warehouse <folder> …``."""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession, functions as F

from tidemill.functions import normalize_semester
from tidemill.operators.check_states import run_stored_checks
from tidemill.operators.ledger import loads_with_rows
from tidemill.operators.quality import freshness
from tidemill.plans.fuel_prices import MODEL, SOURCE
from tidemill.plans.ingest import ingest
from tidemill.plans.staging import build_model, compact_model
from tidemill.plans.upkeep import expire_batches, pack_batches
from tidemill.plans.warehouse import Warehouse
from tidemill.session import build_session
from tidemill.streaming.file_stream import ingest_stream


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemill")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, about in (
        ("ingest", "load new files"),
        ("stream", "load the files that arrived since the last run"),
        ("build", "bring the model up to date"),
        ("check", "run the data-quality checks; fails if one fails"),
        ("freshness", "age of the newest load; fails when it is too old"),
        ("period", "rows of a half-year, or of the one before it when it has none"),
        ("compact", "pack small batches into few folders and fold the model's deltas in"),
        ("expire", "drop slices and batch folders that newer ones replaced; for times without readers"),
    ):
        job = jobs.add_parser(name, help=about)
        job.add_argument("--warehouse", required=True)
        if name in ("ingest", "stream"):
            job.add_argument("--incoming", required=True)
            job.add_argument("--archive")
        if name == "stream":
            job.add_argument("--checkpoint", required=True)
        if name == "period":
            job.add_argument("--year", required=True, type=int)
            job.add_argument("--semester", required=True)
        if name == "build":
            job.add_argument("--full-refresh", action="store_true")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    warehouse = Warehouse(args.warehouse)
    if args.job == "ingest":
        result = ingest(spark, SOURCE, args.incoming, warehouse, archive_root=args.archive)
        print(f"{result.files_loaded} files loaded in {len(result.batches)} batches")
    elif args.job == "stream":
        ingest_stream(spark, SOURCE, args.incoming, warehouse, args.checkpoint, args.archive).awaitTermination()
    elif args.job == "build":
        build_model(spark, SOURCE, MODEL, warehouse, full_refresh=args.full_refresh)
    elif args.job == "check":
        report = run_stored_checks(spark, warehouse.model_table(MODEL), MODEL.checks).collect()  # a line per check
        for line in report:
            print(f"{line['status']:5} {line['column_name']}.{line['check_name']}: {line['failures']}")
        return int(any(line["status"] == "fail" for line in report))
    elif args.job == "freshness":
        now = datetime.now(timezone.utc)
        loads = loads_with_rows(warehouse.read_ledger(spark, SOURCE))
        age = freshness(loads, "ingestion_ts", [now], SOURCE.warn_after_days, SOURCE.error_after_days).first()
        print(f"{age['status']}: newest load {age['newest']}")
        return int(age["status"] == "error")
    elif args.job == "period":
        half = spark.range(1).select(normalize_semester(F.lit(args.semester)).alias("half")).first()["half"]
        rows = warehouse.rows_of_period(spark, SOURCE, f"{args.year}-{half}")
        line = rows.groupBy("partition").agg(F.count("*").alias("n")).first()
        print(f"{line['partition']}: {line['n']} rows")
    elif args.job == "compact":
        pack = pack_batches(spark, SOURCE, warehouse)
        print(f"batches {pack.first} to {pack.last} packed" if pack else "no batches to pack")
        compact_model(spark, MODEL, warehouse)
    elif args.job == "expire":
        folders = expire_batches(spark, SOURCE, warehouse)
        print(f"{folders} batch folders and {warehouse.model_table(MODEL).expire(spark)} stored slices dropped")
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(levelname)s: %(message)s")
    sys.exit(run(build_session(), parser().parse_args()))
