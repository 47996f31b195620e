"""Every query with an oracle matches DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.compare import canon
from tests.conftest import SF_SMALL

ORACLE = E.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck_small, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck_small.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert canon(df.columns, rows) == canon(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert 0.0 <= rows[0]["accuracy"] <= 1.0
