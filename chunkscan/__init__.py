"""Data-driven chunked table reading on Spark."""
