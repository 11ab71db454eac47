"""Spark-native daily market-data foundation."""

__version__ = "0.1.0"
