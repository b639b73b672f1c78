"""Every named query gives the rows its SQL counterpart gives, by an acceptable plan."""

import duckdb
import pytest

from __spark_entry__ import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")
DUCK_TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def sortable(row):
    return [(value is None, str(value)) for value in row]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    result = duck.execute(ORACLES[name])
    types = {c[0]: str(c[1]) for c in result.description}
    expected = [dict(zip(types, row)) for row in result.fetchall()]

    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(types)
    assert {c: DUCK_TYPES.get(t, t) for c, t in df.dtypes if t in DUCK_TYPES} == {
        c: types[c] for c, t in df.dtypes if t in DUCK_TYPES
    }
    columns = sorted(types)
    got = sorted(([row[c] for c in columns] for row in df.collect()), key=sortable)
    want = sorted(([row[c] for c in columns] for row in expected), key=sortable)
    assert len(got) == len(want)
    assert got == want
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in text]
