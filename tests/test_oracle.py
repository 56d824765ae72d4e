"""Every query with a SQL twin gives the twin's rows; the others give rows and a stable schema."""

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = contract.queries(), contract.oracle_sql()
#: Grid searches with many fits; leave them out with ``-m "not slow"``.
SLOW = {"blocked_cv_mlp", "blocked_cv_logreg", "delay_model"}
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(data_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data_dir}/{table}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, data_dir, duck, name):
    found = QUERIES[name](spark, data_dir)
    columns = sorted(found.columns)
    rows = found.select(*(f"`{c}`" for c in columns)).collect()
    cursor = duck.execute(SQL[name])
    described = {c[0]: str(c[1]) for c in cursor.description}
    assert sorted(described) == columns
    kinds = {c: KINDS[t] for c, t in found.dtypes}
    assert {c: described[c] for c in columns} == kinds
    order = [list(described).index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
    assert rows


@pytest.mark.parametrize(
    "name", [pytest.param(n, marks=pytest.mark.slow) if n in SLOW else n for n in sorted(set(QUERIES) - set(SQL))]
)
def test_gives_rows(spark, data_dir, name):
    assert QUERIES[name](spark, data_dir).limit(5).collect()
