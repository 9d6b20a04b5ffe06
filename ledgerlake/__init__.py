"""Ledger marts on Spark: ingest, validate, enrich and aggregate transaction ledgers."""
