"""Every registered query against its DuckDB oracle on the smallest driver scale."""

import os

import pytest

from tools.check import TABLES, _digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _keys():
    import __spark_entry__ as E
    return sorted(E._registry())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["closedate", "nav", "peak_nav", "drawdown"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    assert set(E._registry()) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as E
    df = E.queries()[key](spark, SF)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    idx = {c: i for i, c in enumerate(ocols)}
    orows = [tuple(r[idx[c]] for c in sorted(ocols)) for r in res.fetchall()]
    assert cols == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(srows)[0] == _digest(orows)[0]
