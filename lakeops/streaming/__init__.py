"""Structured Streaming: ingest, aggregates, upserts."""
