"""Structured Streaming variants of the polling loops."""

from jobscope.streaming.landing import alerts_unmatched_after_grace, ingest_landing, run_grace_check  # noqa: F401
