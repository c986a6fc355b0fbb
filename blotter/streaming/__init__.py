"""Structured Streaming versions of the clean layer and hourly counts."""
