"""Operators for preparing training data: dedup, mixing, scoring, sharding, search.

Nothing else in the library imports this package. ``queries.py`` holds the
registered queries and ``oracle.py`` their SQL.
"""
