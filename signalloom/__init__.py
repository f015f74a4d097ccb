"""Retail signal operators on Spark: ingest, quality, signals, marts and layout jobs."""
