"""Every registered training-data query: against SQL, or its shape over the whole table."""

import pytest

from logframe.llm.queries import ORACLE, QUERIES
from tests.compare_results import duck, duck_rows, spark_rows

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(ROOT)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, connection, name):
    names, rows = spark_rows(QUERIES[name](spark, ROOT))
    wanted_names, wanted = duck_rows(connection, ORACLE[name])
    assert names == wanted_names
    assert rows == wanted


def test_registered():
    import __spark_entry__ as driver

    assert set(QUERIES) <= set(driver.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE) <= set(driver.oracle_sql())
