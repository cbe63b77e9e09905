"""Every named query against its SQL on the smallest provided tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_file
from lendrisk.catalog.oracle import ORACLE_SQL
from lendrisk.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="provided tables not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= entry_file.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = entry_file.queries()[name](spark, SF_DIR)
    result = oracle.execute(entry_file.oracle_sql()[name])
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    place = [names.index(column) for column in sorted(names)]
    expected = sorted((tuple(row[i] for i in place) for row in result.fetchall()), key=repr)
    assert {column: TYPES[dtype] for column, dtype in df.dtypes} == types
    assert sorted((tuple(row) for row in df.select(*sorted(df.columns)).collect()), key=repr) == expected


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
