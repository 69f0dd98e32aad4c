"""Streaming queries: one per topic, each with its own table and checkpoint."""
