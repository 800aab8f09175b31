"""Spark-native analytics over public notice postings."""
