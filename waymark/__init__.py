"""Search-log geocoding analytics as DataFrame and Structured Streaming jobs."""
