"""Structured Streaming jobs: broker ingest, silver and gold micro-batches."""
