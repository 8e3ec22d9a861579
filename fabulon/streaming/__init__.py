"""Structured Streaming: event-time windows, keyed state and resumable ingest."""
