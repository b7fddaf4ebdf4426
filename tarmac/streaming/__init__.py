"""Incremental ingest of monthly drops with Structured Streaming."""

from tarmac.streaming.monthly_drops import ingest_monthly_drops  # noqa: F401
