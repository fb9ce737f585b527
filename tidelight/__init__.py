"""Operators for image-stream analytics, written as Spark DataFrame and streaming plans."""

__version__ = "0.1.0"
