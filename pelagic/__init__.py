"""Spark-native analytics over gridded and point observations of the ocean surface."""
