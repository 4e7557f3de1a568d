"""Every registered query against its SQL in DuckDB on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("SKYTRACE_TEST_DIR", "/root/testdata/sf0.01")
STATEMENTS = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query(spark, database, name):
    result = contract.queries()[name](spark, FOLDER)
    cursor = database.execute(STATEMENTS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(names)
    expected = sorted(str(tuple(r)) for r in cursor.fetchall())
    got = sorted(str(tuple(r)) for r in result.select(*[f"`{n}`" for n in names]).collect())
    assert got == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
