"""Registered queries of ``catalog/files.py`` against their SQL."""

from registered import comparison_of

test_query = comparison_of("files")
