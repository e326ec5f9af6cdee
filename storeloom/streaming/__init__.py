"""Incremental ingestion and incremental daily aggregates."""
