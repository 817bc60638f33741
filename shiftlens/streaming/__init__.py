"""Unattended incremental loads with Structured Streaming."""
