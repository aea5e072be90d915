"""Registered queries: every operator on the given tables, next to the same result in plain SQL."""

from herdframe.catalog import (  # noqa: F401  (importing registers the queries)
    aggs,
    columns,
    evaluation,
    files,
    genome,
    joins,
    reshape,
    tasks,
    windows,
)
from herdframe.catalog.base import REGISTRY, Tables, oracle_text, run

__all__ = ["REGISTRY", "Tables", "oracle_text", "run"]
