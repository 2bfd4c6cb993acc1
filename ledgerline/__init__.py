"""Spark-native analytics for following public money."""
