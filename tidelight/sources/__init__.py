"""Readers: image trees, landing zones, sinks and telemetry."""
