"""Every registered query against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}
QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


def _key(value):
    return (value is not None, str(type(value)), value if value is not None else 0)


def _sorted(rows):
    return sorted(rows, key=lambda row: [_key(v) for v in row])


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    rows = _sorted(tuple(r) for r in got.select(*columns).collect())
    assert rows
    if name not in ORACLE:
        return
    want = duck.sql(ORACLE[name])
    types = dict(zip(want.columns, map(str, want.types)))
    assert sorted(types) == columns
    assert {c: TYPES[t] for c, t in got.dtypes} == types
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = _sorted(duck.sql(f"SELECT {picked} FROM ({ORACLE[name]})").fetchall())
    assert len(rows) == len(expected)
    for a, b in zip(rows, expected):
        assert all(_same(x, y) for x, y in zip(a, b)), (a, b)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
