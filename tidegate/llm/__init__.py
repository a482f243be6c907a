"""Operators for preparing training text: dedup, packing, sharding, quality, extraction and tokenising.

``registry`` has the queries over the test tables. Nothing outside this package imports it.
"""
