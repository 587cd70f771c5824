"""Retail customer analytics expressed as Spark DataFrame, ML and streaming jobs."""

__version__ = "0.1.0"
