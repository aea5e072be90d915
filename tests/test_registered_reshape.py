"""Registered queries of ``catalog/reshape.py`` against their SQL."""

from registered import comparison_of

test_query = comparison_of("reshape")
