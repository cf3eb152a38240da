"""Batch analytics on Spark DataFrames: text retrieval, link analysis, least squares."""

__version__ = "0.1.0"
