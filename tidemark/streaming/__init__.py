"""Structured Streaming forms of the incremental edges."""

from tidemark.streaming.incremental import clean_edge, run_available_now, stream_commits

__all__ = ["clean_edge", "run_available_now", "stream_commits"]
