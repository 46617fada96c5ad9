"""Incremental loads fed by Structured Streaming."""

from gildstar.streaming.loads import load_stream, stream_bronze

__all__ = ["load_stream", "stream_bronze"]
