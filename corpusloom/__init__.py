"""Spark-native analytics for scholarly document corpora."""

__version__ = "0.1.0"
