"""Structured Streaming: JSON message ingest with partial or windowed rollups."""

from .stream import (bad_messages, compact_stream_rollup, compact_stream_window,
                     last_committed, purge_compacted, purge_window, read_json_stream, read_stream_rollup,
                     read_stream_window, stream_quarantine, stream_rollup, stream_window)

__all__ = ["bad_messages", "compact_stream_rollup", "compact_stream_window", "last_committed",
           "purge_compacted", "purge_window", "read_json_stream", "read_stream_rollup", "read_stream_window",
           "stream_quarantine", "stream_rollup", "stream_window"]
