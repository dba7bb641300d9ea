"""Tidemark: a Spark-native engine for daily usage-report analytics.

Every operator is a function from DataFrames to a DataFrame; nothing here runs
until the caller asks for rows, except where a docstring says that a bounded
piece of metadata is read first.
"""
