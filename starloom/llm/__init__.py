"""Operators of a training-data pipeline: sharding, archives, tokens, search, filters, dedup, mixing.

Nothing else in the library imports this subpackage; it may use the library's general helpers.
"""
