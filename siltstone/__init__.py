"""Siltstone: a Spark-native engine for filing text, tagged facts and search."""
