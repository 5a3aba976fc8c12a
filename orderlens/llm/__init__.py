"""Operators of a large-scale training-data pipeline, each a function on DataFrames.

Nothing else in the library imports this subpackage; ``queries.py`` registers the queries.
"""
