"""Training-data operators: dedup, search, scans, tokenisation, scoring and filters.

Nothing else in the library imports this subpackage.
"""
