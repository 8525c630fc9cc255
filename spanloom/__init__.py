"""Spark-native analytics over traces of language-model agents."""
