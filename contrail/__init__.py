"""Spark-native analytics over position traces."""
