"""Structured Streaming forms of ingestion, scoring and drift monitoring."""
