"""Registered queries of ``catalog/joins.py`` against their SQL."""

from registered import comparison_of

test_query = comparison_of("joins")
