"""Registered queries of ``catalog/aggs.py`` against their SQL."""

from registered import comparison_of

test_query = comparison_of("aggs")
