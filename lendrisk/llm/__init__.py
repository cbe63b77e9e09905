"""Operators for training-data pipelines: tokens, near copies, extraction, filters, search, mixing, quality.

Nothing else in the library imports this package. Every operator takes DataFrames and returns a DataFrame; ``queries`` holds
the named queries over the provided tables.
"""
