"""Every registered query beside its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
from tools.check import TABLES, compare

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return con


def test_registry_is_consistent():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tiny, duck, name):
    status, _, note = compare(spark, duck, tiny, name, QUERIES[name], SQL[name])
    assert status == "ok", note


@pytest.mark.parametrize("name", ["report_text", "ks_pvalue_exact"])
def test_query_without_sql_returns_rows(spark, tiny, name):
    assert QUERIES[name](spark, tiny).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 6
