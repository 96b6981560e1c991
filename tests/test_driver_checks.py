"""Every registered check agrees with its SQL oracle (DuckDB) on sf0.001,
and the flagship entry runs."""

import os

import pytest

import __spark_entry__ as E
from quartermaster.plans import catalog
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="provided tables missing")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLE.get(name), SF)
    assert r["ok"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["email", "grade"] and df.count() > 0


def test_other_queries_work_without_the_libraries_of_llm():
    """A library that only ``llm`` needs is missing: all other queries stay."""
    import subprocess
    import sys
    code = ("import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as E; from quartermaster.plans import catalog; "
            "assert set(E.queries()) == set(catalog.QUERIES) and len(E.queries()) > 100, len(E.queries()); "
            "assert set(E.oracle_sql()) == set(catalog.ORACLE)")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
