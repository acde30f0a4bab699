"""Every registered query against its SQL, and the shape of its plan."""

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as entry_module
from checks.catalog import QUERIES
from checks.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    expected = duck.sql(entry_module.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(expected.columns) == columns
    table = expected.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert rows(df, *columns) == sorted(table, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, plan_of, name):
    plan = plan_of(entry_module.queries()[name](spark, SF))
    for operator in ("Python", "Arrow", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["CUST_SSN", "total_value", "highlight"]
    assert df.count() == 10
