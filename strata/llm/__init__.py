"""Operators of a training-data pipeline (text quality, dedup, packing, search).

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
thin registered queries, one module per operator holds the operator itself.
"""
