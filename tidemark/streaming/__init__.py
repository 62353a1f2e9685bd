"""Structured Streaming: file ingest and consume-once deltas."""
