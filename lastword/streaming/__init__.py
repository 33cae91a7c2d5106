"""Structured Streaming jobs: ingest, keyed state, maintenance."""
