"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql
from compare import compare, connect
from paperloom.registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR).toArrow(), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).columns == ["query_id", "rank", "doc_id", "score"]
