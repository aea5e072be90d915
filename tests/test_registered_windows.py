"""Registered queries of ``catalog/windows.py`` against their SQL."""

from registered import comparison_of

test_query = comparison_of("windows")
