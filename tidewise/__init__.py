"""Real-time commerce analytics as DataFrame and Structured Streaming code."""

__version__ = "0.1.0"
