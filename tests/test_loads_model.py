"""Set-based load semantics vs a row-by-row model of the reference's loops
(per-symbol transactions, batches of N with stop-at-first-failure, MERGE per row),
on random small loads with overflowing values, repeated keys and target collisions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerframe.operators import loads as L
from test_loads import CONTRACT

hypothesis = pytest.importorskip("hypothesis")
st = hypothesis.strategies
D0 = dt.date(2024, 1, 1)
TS = dt.datetime(2025, 1, 1)
BAD = 99999.0          # overflows decimal(6,2)

row = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.booleans())
loads = st.lists(row, min_size=1, max_size=25)
targets = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5)), max_size=4, unique=True)


def _frames(spark, load, target):
    data = [(i, s, D0 + dt.timedelta(days=d), BAD if bad else float(i)) for i, (s, d, bad) in enumerate(load)]
    new = spark.createDataFrame(data, "seq long, symbol string, trade_date date, px double") \
        .withColumn("update_time", F.lit(TS))
    tgt = spark.createDataFrame([(s, D0 + dt.timedelta(days=d), 1.0, TS) for s, d in target] or [],
                                "symbol string, trade_date date, px double, update_time timestamp")
    return data, new, tgt


def _model_atomic(data, target):
    keys = {(s, D0 + dt.timedelta(days=d)) for s, d in target}
    out = set()
    for unit in sorted({r[1] for r in data}):
        rows_u = [r for r in data if r[1] == unit]
        seen, ok = set(keys), True
        for seq, s, d, px in sorted(rows_u):
            if px == BAD or (s, d) in seen:
                ok = False
                break
            seen.add((s, d))
        if ok:
            out |= {(s, d) for _, s, d, _ in rows_u}
    return out


def _model_prefix(data, target, n):
    keys = {(s, D0 + dt.timedelta(days=d)) for s, d in target}
    out = set()
    for unit in sorted({r[1] for r in data}):
        rows_u = sorted(r for r in data if r[1] == unit)
        for i in range(0, len(rows_u), n):
            batch, seen, ok = rows_u[i:i + n], set(), True
            for _, s, d, px in batch:
                if px == BAD or (s, d) in keys or (s, d) in seen:
                    ok = False
                    break
                seen.add((s, d))
            if not ok:
                break
            keys |= seen
            out |= seen
    return out


def _model_upsert(data, target):
    table = {(s, D0 + dt.timedelta(days=d)): 1.0 for s, d in target}
    for _, s, d, px in sorted(data):
        if px != BAD:
            table[(s, d)] = px
    return table


def test_loads_match_row_by_row_model(spark):
    @hypothesis.settings(max_examples=10, deadline=None, derandomize=True)
    @hypothesis.given(loads, targets)
    def check(load, target):
        data, new, tgt = _frames(spark, load, target)
        acc, _ = L.append_atomic(new, tgt, CONTRACT, unit="symbol")
        assert {(r["symbol"], r["trade_date"]) for r in acc.collect()} == _model_atomic(data, target)
        acc, _ = L.append_prefix(new, tgt, CONTRACT, unit="symbol", order="seq", batch_size=2,
                                 block_rows=3)
        assert {(r["symbol"], r["trade_date"]) for r in acc.collect()} == _model_prefix(data, target, 2)
        merged, _ = L.upsert(tgt, new, CONTRACT, seq="seq")
        assert {(r["symbol"], r["trade_date"]): float(r["px"]) for r in merged.collect()} == \
            _model_upsert(data, target)

    check()
