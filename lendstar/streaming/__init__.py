"""Incremental ingestion of delivery files with Structured Streaming."""

from lendstar.streaming.deliveries import ingest_deliveries

__all__ = ["ingest_deliveries"]
