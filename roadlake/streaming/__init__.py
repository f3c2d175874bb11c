"""Structured Streaming jobs: the collector and the scorer."""
