"""Spark-native analytics over article collections: text to temporal graph."""
