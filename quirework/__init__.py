"""Spark-native engine for libraries of long Markdown documents."""
