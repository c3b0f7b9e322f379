"""Every registered query against DuckDB on the whole tables."""

import pytest

from registered.oracle import ORACLE
from registered.queries import QUERIES
from tests.compare_results import duck, duck_rows, spark_rows

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(ROOT)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, connection, name):
    names, rows = spark_rows(QUERIES[name](spark, ROOT))
    wanted_names, wanted = duck_rows(connection, ORACLE[name])
    assert names == wanted_names
    assert rows == wanted


# DuckDB's names of the types that results have.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_types_as_sql(spark, connection, name):
    described = connection.execute(f"describe {ORACLE[name]}").fetchall()
    wanted = {column: kind for column, kind, *_ in described}
    found = {column: TYPES[kind] for column, kind in QUERIES[name](spark, ROOT).dtypes}
    assert found == wanted


def test_entry(spark):
    import __spark_entry__ as driver

    assert len(driver.entry(spark).collect()) == 15
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0
