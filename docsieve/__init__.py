"""Explore, cluster and screen large document collections with Spark DataFrames."""

__version__ = "0.1.0"
