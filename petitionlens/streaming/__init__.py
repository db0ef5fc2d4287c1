"""Incremental (Structured Streaming) forms of the ingest job."""

from petitionlens.streaming.ingest import ingest_available, start_incremental_ingest
from petitionlens.streaming.loads import ingest_available_loads

__all__ = ["ingest_available", "ingest_available_loads", "start_incremental_ingest"]
