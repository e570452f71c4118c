"""Spark-native curation of agent training data: decode, normalize, validate, deduplicate, score, audit."""

__version__ = "0.1.0"
