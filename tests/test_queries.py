"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check import TABLES, lines

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_sql_has_its_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, con, name):
    result = queries()[name](spark, SF_DIR)
    relation = con.execute(oracle_sql()[name])
    names = [column[0] for column in relation.description]
    assert sorted(result.columns) == sorted(names)
    assert lines(result.columns, result.collect()) == lines(names, relation.fetchall())
