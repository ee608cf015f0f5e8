"""Operators of a training-data pipeline: quality, dedup, mixing, formatting, packing, search, scoring.

Nothing else in the library imports this subpackage.
"""
