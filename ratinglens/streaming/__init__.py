"""Speed layer on Structured Streaming."""
