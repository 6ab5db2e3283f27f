"""Operators for preparing large text corpora: deduplication, filtering, search, mixing and token files.

Every operator is a function from DataFrames to DataFrames with parameters for its column names; ``queries`` binds
them to the given tables. Nothing else in the library imports this package.
"""
