"""Every query that has SQL gives what DuckDB gives on the same tables."""

import math

import duckdb
import pytest

from tidemark.plans import calibration_queries, case_queries, executive_queries, operator_queries, table_queries, typology_queries  # noqa: F401
from tidemark.plans.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert got
        return
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == rows(want.columns, want.fetchall())
