"""Every registered query against its SQL twin."""

import pytest

from sitebooks.catalog import ORACLE, QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_entry_is_the_flagship(spark, sf_dir):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert "needed" in df.columns
    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) >= set(ORACLE)


def test_sorted_output_is_in_order(spark, sf_dir):
    got = [tuple(r) for r in QUERIES["sorted_output"](spark, sf_dir).collect()]
    by_name = sorted(got, key=lambda r: r[1], reverse=True)
    assert got == sorted(by_name, key=lambda r: r[0])
