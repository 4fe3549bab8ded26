"""Structured Streaming: deduplication and the hops of the article stream."""
