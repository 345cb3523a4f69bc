"""Layered, incrementally maintained time-series tables on Spark.

Every operator is a plain function from DataFrames to DataFrames, so Catalyst
sees one declarative plan per query.  See README.md for the map of modules.
"""
