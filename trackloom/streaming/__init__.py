"""Online operators for Structured Streaming."""
