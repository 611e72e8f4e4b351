import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

import oracle  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from newsflow import queries as base  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: entry_module.queries()[name] for name in base.QUERIES}
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() <= SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    rows, differences = oracle.compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR)
    assert not differences, differences[:3]
    assert rows > 0


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
