"""The contract of the entry module, and that every registered query has a test file."""

import glob
import os

from registered import names_of

from herdframe.catalog import REGISTRY


def test_every_query_is_in_a_file():
    files = glob.glob(os.path.join(os.path.dirname(os.path.abspath(__file__)), "test_registered_*.py"))
    modules = [os.path.basename(f)[len("test_registered_") : -len(".py")] for f in files]
    assert sorted(n for m in modules for n in names_of(m)) == sorted(REGISTRY)


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
