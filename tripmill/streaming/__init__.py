"""File arrival as Structured Streaming."""
