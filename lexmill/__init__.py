"""Spark-native corpus preparation: tag, deduplicate, filter, rewrite and lay out text."""
