"""Glyphweave: a PySpark-native engine for Unicode-sensitive document corpora."""

__version__ = "0.1.0"
