"""Spark-native keyword analytics engine."""
