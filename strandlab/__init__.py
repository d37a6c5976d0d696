"""Spark-native analytics for modified-base alignments."""
