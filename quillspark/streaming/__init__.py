"""Structured Streaming: documents and events as they arrive."""
