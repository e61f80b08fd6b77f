"""Airline-operations analytics as PySpark DataFrame, streaming and ML jobs."""

__version__ = "0.1.0"
