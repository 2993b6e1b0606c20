"""Structured Streaming: file-stream ingestion, streaming dedup, windowed
counts, exactly-once micro-batch writes."""
