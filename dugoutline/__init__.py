"""Spark-native processing of news-derived entity data."""
