"""Spark-native analytics for EVM event tables."""
