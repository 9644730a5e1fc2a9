"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from sqlscore.sources.tables import TABLES

from conftest import SF001

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(x)
        return repr(x)
    return sorted("|".join(v(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLE[name])
    want = canon(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert got == want
