"""Incremental harvests with Structured Streaming."""

from sheaf.streaming.incremental import landing_counts, read_landing_stream, stream_harvest

__all__ = ["landing_counts", "read_landing_stream", "stream_harvest"]
