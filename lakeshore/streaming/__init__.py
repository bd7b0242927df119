"""Structured Streaming: ingest, alerts and running totals."""
