"""Structured Streaming forms of gating, upserting and segmenting (STR-01 .. STR-03)."""

from tidemark.streaming.jobs import (  # noqa: F401
    gate_quotes_stream, run_available, segment_stream, session_stream, state_session, upsert_batches,
)
