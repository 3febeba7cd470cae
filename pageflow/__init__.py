"""Batch and streaming operators for page-creation events, as plain Spark DataFrames."""
