"""Registered queries of ``catalog/tasks.py`` against their SQL."""

from registered import comparison_of

test_query = comparison_of("tasks")
