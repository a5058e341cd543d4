"""Incremental bronze -> silver runs as Structured Streaming (availableNow) jobs."""
