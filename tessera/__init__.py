"""Spark-native entity resolution."""
