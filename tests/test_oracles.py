"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

from conftest import SF_SMALL
from tools.compare import rows_of

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
NAMES = sorted(ORACLES)


def test_every_query_has_an_entry():
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 100


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_time" in df.columns
