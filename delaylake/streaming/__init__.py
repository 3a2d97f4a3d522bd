"""Structured Streaming: incremental snapshot ingest, dedupe, newest row per key, coverage."""

from .streams import batch_folder, coverage_stream, dedupe_stream, dropped_rows, file_stream, newest_stream, run_available, snapshot_stream

__all__ = ["batch_folder", "coverage_stream", "dedupe_stream", "dropped_rows", "file_stream", "newest_stream", "run_available", "snapshot_stream"]
