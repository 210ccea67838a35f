"""Bounded-batch ingestion with Structured Streaming."""
