"""Structured Streaming jobs: raw landing and incremental feature upkeep."""
