"""Every registered query against its SQL in another engine, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from tools.compare import compare, connect
from workloads.oracle import registry as oracle_sql
from workloads.queries import registry as queries


@pytest.fixture(scope="module")
def connection(small_dir):
    return connect(small_dir)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, small_dir, connection, name):
    assert compare(spark, connection, queries()[name], oracle_sql()[name], small_dir) is None


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
