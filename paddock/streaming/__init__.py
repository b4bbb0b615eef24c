"""Structured Streaming form of the incremental (delivery folder) load."""

from paddock.streaming.deliveries import delivery_stream, ingest_deliveries

__all__ = ["delivery_stream", "ingest_deliveries"]
