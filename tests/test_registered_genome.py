"""Registered queries of ``catalog/genome.py`` against their SQL."""

from registered import comparison_of

test_query = comparison_of("genome")
