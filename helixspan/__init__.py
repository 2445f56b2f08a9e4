"""Spark-native operators and pipelines for genetic association statistics."""
