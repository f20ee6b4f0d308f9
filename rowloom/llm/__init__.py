"""Operators that prepare training data: deduplication, filtering, tokenising, packing, search.

Nothing else in the library imports this subpackage.
"""
