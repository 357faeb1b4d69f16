"""Spark-native analytics for incident-style open data."""
