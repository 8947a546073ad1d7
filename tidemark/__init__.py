"""Tidemark: a Spark-first engine for building and auditing time-series analysis datasets."""

__version__ = "0.1.0"
