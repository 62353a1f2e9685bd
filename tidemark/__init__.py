"""Incremental medallion ELT on Spark: extract, land, ingest, deduplicate, cast, audit, and load gold tables."""
