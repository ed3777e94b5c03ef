"""Dated-ownership production analytics on Spark DataFrames."""
