"""Every registered query against its DuckDB oracle at sf 0.001 (the driver checks sf 0.01)."""

import pytest

import __spark_entry__ as E
from checks.compare import _rows

from parcelwise.plans.registry import QUERIES

KEYS = sorted(QUERIES)
ORACLE = E.oracle_sql()


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(KEYS) - set(ORACLE)
    assert rows_only == set(), rows_only
    assert set(ORACLE) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 5
    assert df.columns[0] == "warehouse_block"


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, duck_small, key):
    df = E.queries()[key](spark, sf_small)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck_small.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert _rows(cols, rows) == _rows(ocols, orows)
