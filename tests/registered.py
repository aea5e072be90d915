"""Comparison of registered queries with their SQL on the smallest data, used by one test file per module of the catalog.

A file has its own session, so one that dies does not hide the results of the others.
"""

import os

import pytest
from oracle import compare, duck

from herdframe.catalog import REGISTRY, oracle_text, run

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def names_of(module: str) -> list[str]:
    return [name for name, (fn, _) in REGISTRY.items() if fn.__module__ == f"herdframe.catalog.{module}"]


def comparison_of(module: str):
    @pytest.mark.parametrize("name", names_of(module))
    def test_query(spark, name):
        sql = REGISTRY[name][1]
        df = run(name, spark, FOLDER)
        if sql is None:
            assert len(df.take(1)) == 1
        else:
            assert compare(df, duck(FOLDER), oracle_text(sql)) is None

    return test_query
