"""Spark-native analytics over recorded agent episodes."""
