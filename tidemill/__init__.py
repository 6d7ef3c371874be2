"""Exactly-once file ingestion, typed cleaning, keyed upserts and data-quality checks on Spark."""
