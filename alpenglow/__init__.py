"""Alpenglow: daily weather analytics along elevation routes, as Spark jobs."""

__version__ = "0.1.0"
