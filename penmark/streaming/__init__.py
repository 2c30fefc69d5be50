"""The batch steps over Structured Streaming."""
