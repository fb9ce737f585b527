"""Structured Streaming queries over landing zones, and their telemetry."""
