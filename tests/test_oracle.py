"""Every registered query against its SQL form on the smallest tables."""

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from compare import check, duck
from newsloom.workload.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert check(spark, con, SF, name, QUERIES[name], ORACLE[name]) is None


def test_every_query_has_its_sql_form():
    assert set(QUERIES) == set(ORACLE)
