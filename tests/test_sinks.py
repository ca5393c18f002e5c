"""Write paths: full refresh (A15), materialise (A21), partition-scoped merge."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from suite_helpers import rows
from ledgerframe.operators import loads as L
from test_loads import CONTRACT

D = dt.date
TS = dt.datetime(2025, 1, 1)


def _frame(spark, data):
    return (spark.createDataFrame(data, "seq long, symbol string, trade_date date, px double")
            .withColumn("update_time", F.lit(TS)))


def test_full_refresh_and_materialise(spark):
    base = tempfile.mkdtemp(prefix="ledgerframe-sink-")
    path = os.path.join(base, "t")
    staging = os.path.join(base, "staging")
    L.full_refresh(_frame(spark, [(1, "a", D(2024, 1, 1), 1.0)]), path, staging)
    L.full_refresh(_frame(spark, [(2, "b", D(2024, 1, 2), 2.0)]), path, staging)   # replaces, not appends
    assert rows(spark.read.parquet(path).select("symbol")) == [("b",)]
    m = L.materialise(_frame(spark, [(3, "c", D(2024, 1, 3), 3.0)]), os.path.join(base, "m"))
    assert rows(m.select("seq")) == [(3,)]


def test_merge_into_path_rewrites_touched_partitions_only(spark):
    base = tempfile.mkdtemp(prefix="ledgerframe-merge-")
    path, staging = os.path.join(base, "target"), os.path.join(base, "staging")
    target = (_frame(spark, [(0, "a", D(2024, 1, 1), 1.0), (0, "b", D(2024, 2, 1), 5.0)]).drop("seq")
              .withColumn("px", F.col("px").cast("decimal(6,2)")))        # stored in contract types
    target.withColumn("ym", F.date_format("trade_date", "yyyy-MM")).write \
        .partitionBy("ym").parquet(path)
    before = os.path.getmtime(os.path.join(path, "ym=2024-02"))
    src = _frame(spark, [(1, "a", D(2024, 1, 1), 2.0), (2, "c", D(2024, 1, 5), 3.0), (3, "c", None, 3.0)])
    rejects = L.merge_into_path(spark, path, src, CONTRACT, "seq", F.date_format("trade_date", "yyyy-MM").alias("ym"), staging)
    assert rows(rejects.select("seq", "reason")) == [(3, "null:trade_date")]
    assert os.path.getmtime(os.path.join(path, "ym=2024-02")) == before
    out = rows(spark.read.parquet(path).select("symbol", "trade_date", "px"))
    assert out == [("a", D(2024, 1, 1), 2.0), ("b", D(2024, 2, 1), 5.0), ("c", D(2024, 1, 5), 3.0)]


def test_target_check_opens_only_partitions_of_the_new_dates(spark):
    """A date-partitioned target: a late row and one of today leave the dates between unread."""
    base = tempfile.mkdtemp(prefix="ledgerframe-prune-")
    path = os.path.join(base, "daily")
    days = [D(2020, 1, 2), *[D(2023, m, 2) for m in range(1, 13)], D(2024, 1, 2)]
    old = _frame(spark, [(0, "a", d, 1.0) for d in days]).drop("seq").withColumn("px", F.col("px").cast("decimal(6,2)"))
    old.write.partitionBy("trade_date").parquet(path)
    target = spark.read.parquet(path)
    for d in days[1:-1]:  # reading one of these files would fail
        folder = os.path.join(path, f"trade_date={d}")
        for name in os.listdir(folder):
            with open(os.path.join(folder, name), "wb") as fh:
                fh.write(b"torn")
    new = _frame(spark, [(1, "a", D(2020, 1, 2), 2.0), (2, "b", D(2024, 1, 2), 2.0), (3, "c", D(2024, 1, 3), 2.0)])
    for load in (L.append_atomic, lambda *a, **k: L.append_prefix(*a, order="seq", **k)):
        acc, failed = load(new, target, CONTRACT, unit="symbol", range_key="trade_date")
        assert rows(acc.select("symbol")) == [("b",), ("c",)]
        assert rows(failed.select("symbol")) == [("a",)]


def test_upsert_passes_rows_of_other_keys_without_a_join(spark):
    """The key filter: all kept target rows come out once, whatever the number of keys per bit."""
    from ledgerframe.operators import keyset as K
    target = spark.range(5000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("symbol"),
                                      F.lit(D(2024, 1, 1)).alias("trade_date"), F.lit(1).cast("decimal(6,2)").alias("px"),
                                      F.lit(TS).alias("update_time"))
    src = spark.range(4990, 5010).select(F.col("id").alias("seq"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("symbol"),
                                         F.lit(D(2024, 1, 1)).alias("trade_date"), F.lit(2.0).alias("px"), F.lit(TS).alias("update_time"))
    merged, _ = L.upsert(target, src, CONTRACT, "seq")
    assert rows(merged.groupBy("px").count()) == [(1, 4990), (2, 20)]
    keys = ["symbol", "trade_date"]
    for bits, most in ((6, 5000), (20, 5)):
        passed = target.filter(K.may_hold(K.key_bits(src, keys, bits), keys, bits))
        assert passed.join(src, keys, "left_semi").count() == 10
        assert passed.count() - 10 <= most
    assert target.filter(K.may_hold(K.key_bits(src.limit(0), keys), keys)).count() == 0


def test_scan_files_csv_and_json_with_schema(spark):
    from ledgerframe.sources.tables import scan_files
    base = tempfile.mkdtemp(prefix="ledgerframe-scan-")
    csv = os.path.join(base, "feed.csv")
    with open(csv, "w") as fh:
        fh.write("seq,code,trade_date,pe\n1,600000,2024-01-02,6.5\n2,830001,N/A,--\n")
    df = scan_files(spark, csv, "csv", "seq long, code string, trade_date string, pe string")
    assert rows(df) == [(1, "600000", "2024-01-02", "6.5"), (2, "830001", "N/A", "--")]
    js = os.path.join(base, "feed.json")
    with open(js, "w") as fh:
        fh.write('{"code": "600000", "seq": 1}\n')
    assert rows(scan_files(spark, js, "json", "seq long, code string")) == [(1, "600000")]


def test_pivot_panel_wide_form(spark):
    from ledgerframe.plans import sectors as Z
    panel = spark.createDataFrame([(D(2024, 1, 1), "s1", "X"), (D(2024, 1, 1), "s2", "UNK"),
                                   (D(2024, 1, 2), "s1", "Y"), (D(2024, 1, 2), "s2", "Z")],
                                  "date date, symbol string, industry_code string")
    wide = Z.pivot_panel(panel, "industry_code", ["s1", "s2"])
    assert wide.columns == ["date", "s1", "s2"]
    assert rows(wide) == [(D(2024, 1, 1), "X", "UNK"), (D(2024, 1, 2), "Y", "Z")]


def test_market_bundle_readme_example(spark):
    from ledgerframe.plans import portfolio as P, risk as R
    from ledgerframe.sources import bridge
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    m = bridge.market(spark, sf)
    pos = P.net_positions(m.trades, m.calendar, m.summary)
    pl = P.daily_pl(pos, m.trades, m.calendar, m.closeprices, m.summary)
    worst = R.worst_drawdown(P.nav(pl)).collect()
    assert len(worst) == 1 and worst[0]["drawdown"] <= 0


def _px(df):
    return [(s, d, float(p)) for s, d, p in rows(df.select("symbol", "trade_date", "px"))]


def _stop_before_commit(monkeypatch):
    from ledgerframe.operators import versions as V

    def lost(*_):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(V, "_commit", lost)


def test_refresh_interrupted_between_its_steps_leaves_the_old_table(spark, monkeypatch):
    import pytest
    from ledgerframe.operators import versions as V
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerframe-commit-"), "t")
    schema = CONTRACT.schema
    assert V.read(spark, path, schema).count() == 0
    first = L.refresh_commit(_frame(spark, [(1, "a", D(2024, 1, 1), 1.0)]), path)
    reader = V.read(spark, path)
    with monkeypatch.context() as m:
        _stop_before_commit(m)
        with pytest.raises(RuntimeError):
            L.refresh_commit(_frame(spark, [(2, "b", D(2024, 1, 2), 2.0)]), path)
    assert _px(V.read(spark, path)) == [("a", D(2024, 1, 1), 1.0)]
    # a commit whose job ended before its marker was made doesn't count either
    torn = V.latest(spark, path) + 2
    os.makedirs(os.path.join(path, "commits", str(torn)))
    assert V.latest(spark, path) == first
    second = L.refresh_commit(_frame(spark, [(2, "b", D(2024, 1, 2), 2.0)]), path)
    assert second > torn and _px(V.read(spark, path)) == [("b", D(2024, 1, 2), 2.0)]
    assert _px(reader) == _px(V.read(spark, path, commit=first)) == [("a", D(2024, 1, 1), 1.0)]
    L.refresh_commit(_frame(spark, []), path)
    assert V.read(spark, path, schema).count() == 0


def test_merge_commit_replaces_touched_partitions_at_once(spark, monkeypatch):
    import pytest
    from ledgerframe.operators import versions as V
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerframe-commit-"), "t")
    month = F.date_format("trade_date", "yyyy-MM")
    old = [(0, "a", D(2024, 1, 1), 1.0), (0, "b", D(2024, 2, 1), 5.0), (0, "c", D(2024, 3, 1), 6.0)]
    V.replace(_frame(spark, old).drop("seq").withColumn("px", F.col("px").cast("decimal(6,2)")), path, month)
    src = _frame(spark, [(1, "a", D(2024, 1, 1), 2.0), (2, "d", D(2024, 3, 5), 3.0), (3, "c", None, 3.0)])
    with monkeypatch.context() as m:
        _stop_before_commit(m)
        with pytest.raises(RuntimeError):
            L.merge_commit(spark, path, src, CONTRACT, "seq", month)
    assert _px(V.read(spark, path)) == [(s, d, p) for _, s, d, p in old]
    # the untouched partition isn't opened: its file could not be read
    held = V._held(spark, path, V.latest(spark, path))
    folder = f"{path}/data/_version={held['2024-02']}/_partition=2024-02"
    kept = {n: open(f"{folder}/{n}", "rb").read() for n in os.listdir(folder)}
    for n in kept:
        open(f"{folder}/{n}", "wb").write(b"torn")
    rejects = L.merge_commit(spark, path, src, CONTRACT, "seq", month)
    for n, data in kept.items():
        open(f"{folder}/{n}", "wb").write(data)
    assert rows(rejects.select("seq", "reason")) == [(3, "null:trade_date")]
    want = [("a", D(2024, 1, 1), 2.0), ("b", D(2024, 2, 1), 5.0), ("c", D(2024, 3, 1), 6.0), ("d", D(2024, 3, 5), 3.0)]
    assert _px(V.read(spark, path)) == want
    L.merge_commit(spark, path, src, CONTRACT, "seq", month)  # a job run twice changes nothing
    assert _px(V.read(spark, path)) == want


def test_ledger_makes_a_repeat_a_no_op_and_a_change_an_error(spark):
    import pytest
    from ledgerframe.operators import ledger as G
    schema = "unit string, x int, y string"
    feed = spark.createDataFrame([("u", 1, "a"), ("u", 1, "a"), ("v", 2, None), (None, 3, "z")], schema)
    book = G.contents(feed, "job", "unit")
    again = spark.createDataFrame([("v", 2, None), ("u", 1, "a"), ("w", 4, "n"), ("u", 1, "a")], schema)
    assert rows(G.compare(again, book, "job", "unit")) == [("u", 2, "repeat"), ("v", 1, "repeat"), ("w", 1, "new")]
    assert rows(G.not_loaded(again, book, "job", "unit")) == [("w", 4, "n")]
    assert G.not_loaded(again, book, "other job", "unit").count() == 4
    assert G.not_loaded(feed, book, "job", "unit").count() == 0  # the null unit is one too
    for change in ([("u", 1, "a")], [("u", 1, "a"), ("u", 1, "b")], [("v", None, "2")]):
        changed = spark.createDataFrame(change, schema)
        assert [r["status"] for r in G.compare(changed, book, "job", "unit").collect()] == ["conflict"]
        with pytest.raises(Exception, match="loaded with other rows before"):
            G.not_loaded(changed, book, "job", "unit").collect()
