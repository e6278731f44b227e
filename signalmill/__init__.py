"""Batch and streaming analytics on delimited signal data, built on PySpark."""
