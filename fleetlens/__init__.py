"""Vessel-position analytics on PySpark DataFrames and Structured Streaming."""
