"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from folia.session import TABLES

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con(tiny):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{tiny}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def cell(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return ""
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    return sorted(tuple(cell(r[k]) for k in order) for r in data)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, tiny, con, name):
    df = entry.queries()[name](spark, tiny)
    sql = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(sql.columns)
    assert rows(df.columns, df.collect()) == rows(sql.columns, sql.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
