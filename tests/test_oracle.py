"""Every catalogue query against its SQL on an independent engine."""

import duckdb
import pytest

import __spark_entry__ as entry
from stayframe.plans.catalog import QUERIES
from stayframe.plans.oracle import ORACLES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def sortable(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    expected = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    types = {c: TYPES.get(str(t)) for c, t in zip(expected.columns, expected.types)}
    assert dict(df.dtypes) == types
    got = sortable([tuple(r[c] for c in columns) for r in df.collect()])
    wanted = sortable(expected.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert got == wanted


def test_entry_runs(spark):
    assert len(entry.entry(spark).columns) == 50
