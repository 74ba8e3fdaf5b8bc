"""Structured Streaming job around the batch scoring function."""

from selfmend.streaming.commits import committed, committed_batches
from selfmend.streaming.serve import ServeConfig, landing_stream, process_batch, serve
from selfmend.streaming.versions import publish

__all__ = ["ServeConfig", "committed", "committed_batches", "landing_stream", "process_batch", "publish", "serve"]
