"""Structured Streaming jobs that keep document and graph state up to date."""
