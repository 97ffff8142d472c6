"""The incremental merge as a Structured Streaming query."""
