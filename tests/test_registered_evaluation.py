"""Registered queries of ``catalog/evaluation.py`` against their SQL."""

from registered import comparison_of

test_query = comparison_of("evaluation")
