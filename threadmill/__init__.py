"""Spark-native engine that rebuilds chat transcripts from positioned screen text."""
