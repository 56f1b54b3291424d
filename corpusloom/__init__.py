"""Spark-native engine for curating speech-and-text corpora."""

__version__ = "0.1.0"
