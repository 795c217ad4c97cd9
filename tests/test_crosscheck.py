"""Every registered query against its SQL on the smallest bench data."""

import pytest

import __spark_entry__ as entry
from crosscheck.compare import compare, connect
from crosscheck.oracle import ORACLE as LIBRARY_ORACLE
from crosscheck.queries import QUERIES as LIBRARY_QUERIES

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_queries_of_the_library_have_sql():
    """Queries beyond SQL are tested against plain versions where they are defined."""
    assert set(ORACLE) <= set(QUERIES)
    assert set(LIBRARY_QUERIES) == set(LIBRARY_ORACLE)


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, con, sf_dir, name):
    same, text = compare(spark, con, sf_dir, name, QUERIES[name], ORACLE[name])
    assert same, text
