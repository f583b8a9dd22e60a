"""Every registered query with SQL gives the rows and types of that SQL."""

import pytest

import __spark_entry__ as contract
import compare

ORACLE = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def db(sf_dir):
    return compare.connect(sf_dir)


def test_every_sql_has_a_query():
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, db, sf_dir, name):
    assert compare.check(spark, db, QUERIES[name], ORACLE[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    found = contract.entry(spark)
    assert found.count() == 10
    assert found.columns == ["row_id", "grid_cell", "parquet_file", "row_group", "row_in_rg", "cluster_id"]
