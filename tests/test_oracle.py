"""Every registered query against its DuckDB oracle on sf0.001 (the driver's check runs
the same comparison on sf0.01); queries without an oracle must at least run."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tools.oracle_check import canon

from .conftest import SMALL

QUERIES = E.queries()
SQL = E.oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == E.entry(spark).columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows, cols = df.collect(), df.columns
    assert len(set(cols)) == len(cols), "duplicate output column names"
    if name not in SQL:
        return
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    a, b = canon(cols, rows), canon(dcols, drows)
    assert len(a) == len(b)
    assert a == b
