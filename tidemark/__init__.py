"""Incremental customer-support analytics on Spark DataFrames."""
