"""Structured Streaming jobs: source, shared transformation, sink."""
