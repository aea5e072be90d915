"""Registered queries of ``catalog/columns.py`` against their SQL."""

from registered import comparison_of

test_query = comparison_of("columns")
