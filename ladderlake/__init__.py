"""Spark-native medallion and star-schema analytics for match statistics."""
