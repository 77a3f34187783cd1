"""Every registered query against its DuckDB SQL at sf0.01 (rows, columns, values)."""

import os

import pytest

from conftest import SF01
from stationday.plans.oracle import ORACLE_SQL
from stationday.plans.queries import QUERIES
from tools.oracle_check import TABLES, compare


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF01}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF01)
    assert r["cols_ok"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["hash_ok"], r
