"""Structured Streaming jobs."""

from postlake.streaming.dedup import dedup_stream, new_ids_per_minute
from postlake.streaming.ingest import ingest_batch, ingest_stream, split_bad

__all__ = ["dedup_stream", "new_ids_per_minute", "ingest_batch", "ingest_stream", "split_bad"]
