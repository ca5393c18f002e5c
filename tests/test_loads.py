"""Load semantics per failure scope (A14-A20) and cleaning helpers."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType, StructField, StructType, TimestampType

from suite_helpers import rows
from ledgerframe.functions import cleaning as C
from ledgerframe.operators import loads as L
from ledgerframe.operators.contract import Contract, split_contract

D = dt.date
TS = dt.datetime(2025, 1, 1)

CONTRACT = Contract(StructType([
    StructField("symbol", StringType(), False), StructField("trade_date", DateType(), False),
    StructField("px", DecimalType(6, 2), True), StructField("update_time", TimestampType(), False),
]), pk=["symbol", "trade_date"], lengths={"symbol": 8})


def _rows(spark, data):
    df = spark.createDataFrame(data, "seq long, symbol string, trade_date date, px double")
    return df.withColumn("update_time", F.lit(TS))


def test_contract_reasons(spark):
    df = _rows(spark, [(1, "sh600000", D(2024, 1, 1), 1.5), (2, "sh600000", None, 1.0),
                       (3, "sh6000001", D(2024, 1, 1), 12345.0)])
    good, bad = split_contract(df, CONTRACT)
    assert rows(good.select("seq")) == [(1,)]
    assert rows(bad.select("seq", "reason")) == [(2, "null:trade_date"),
                                                 (3, "length:symbol;invalid:px")]


def test_append_atomic_rolls_back_whole_symbol(spark):
    new = _rows(spark, [(1, "a", D(2024, 1, 1), 1.0), (2, "a", D(2024, 1, 2), 99999.0),  # overflow
                        (3, "b", D(2024, 1, 1), 1.0), (4, "b", D(2024, 1, 2), 2.0),
                        (5, "c", D(2024, 1, 1), 1.0)])
    target = _rows(spark, [(0, "c", D(2024, 1, 1), 1.0)]).select("symbol", "trade_date", "px", "update_time")
    acc, failed = L.append_atomic(new, target, CONTRACT, unit="symbol")
    assert rows(acc.select("symbol", "trade_date")) == [("b", D(2024, 1, 1)), ("b", D(2024, 1, 2))]
    assert rows(failed.select("symbol", "reasons")) == [("a", ["invalid:px"]), ("c", ["key_in_target"])]


def test_append_atomic_duplicate_key_and_bad_date(spark):
    new = _rows(spark, [(1, "a", D(2024, 1, 1), 1.0), (2, "a", D(2024, 1, 1), 2.0),
                        (3, "b", D(2024, 1, 1), 1.0)]).withColumn("_bad_date", F.col("seq") == 3)
    acc, failed = L.append_atomic(new, None, CONTRACT, unit="symbol", bad_flag="_bad_date")
    assert acc.count() == 0
    assert rows(failed.select("symbol", "reasons")) == [("a", ["duplicate_key"]), ("b", ["unparsed_date"])]


def test_append_prefix_keeps_earlier_batches(spark):
    data = [(i, "a", D(2024, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(10)]
    data[6] = (6, "a", D(2024, 1, 7), 99999.0)          # batch 2 (batch size 3) fails
    data += [(20, "b", D(2024, 1, 1), 1.0), (21, "b", D(2024, 1, 1), 1.0)]  # repeat in batch 0
    acc, failed = L.append_prefix(_rows(spark, data), None, CONTRACT, unit="symbol", order="seq",
                                  batch_size=3, block_rows=4)
    assert rows(acc.select("symbol", "trade_date")) == [("a", D(2024, 1, 1) + dt.timedelta(days=i)) for i in range(6)]
    assert rows(failed) == [("a", 2, 4), ("b", 0, 2)]


def test_upsert_last_row_wins_and_null_key_rejected(spark):
    target = _rows(spark, [(0, "a", D(2024, 1, 1), 1.0), (0, "z", D(2024, 1, 1), 9.0)]).drop("seq")
    src = _rows(spark, [(1, "a", D(2024, 1, 1), 2.0), (2, "a", D(2024, 1, 1), 3.0),
                        (3, "a", D(2024, 1, 1), 99999.0),    # bad row skipped, 3.0 stays
                        (4, "b", None, 1.0), (5, "b", D(2024, 1, 2), 4.0)])
    merged, rejects = L.upsert(target, src, CONTRACT, seq="seq")
    got = rows(merged.select("symbol", "trade_date", "px"))
    assert [(s, d, float(p)) for s, d, p in got] == [("a", D(2024, 1, 1), 3.0), ("b", D(2024, 1, 2), 4.0),
                                                     ("z", D(2024, 1, 1), 9.0)]
    assert rows(rejects.select("seq", "reason")) == [(3, "invalid:px"), (4, "null:trade_date")]


def test_full_refresh_is_all_or_nothing(spark):
    ok = _rows(spark, [(1, "a", D(2024, 1, 1), 1.0), (2, "b", D(2024, 1, 1), 1.0)])
    assert L.full_refresh_rows(ok, CONTRACT).count() == 2
    dup = _rows(spark, [(1, "a", D(2024, 1, 1), 1.0), (2, "a", D(2024, 1, 1), 1.0), (3, "b", D(2024, 1, 1), 1.0)])
    assert L.full_refresh_rows(dup, CONTRACT).count() == 0
    assert rows(L.full_refresh_rejects(dup, CONTRACT)) == [("a", D(2024, 1, 1), 2, "duplicate_key")]
    big = _rows(spark, [(1, "a", D(2024, 1, 1), 99999.0)])
    assert rows(L.full_refresh_rejects(big, CONTRACT)) == [("a", D(2024, 1, 1), 1, "invalid:px")]


def test_repeated_key_across_units(spark):
    new = _rows(spark, [(1, "a", D(2024, 1, 1), 1.0), (2, "a", D(2024, 1, 1), 1.0), (3, "b", D(2024, 1, 2), 1.0)]) \
        .withColumn("part", F.col("seq"))
    acc, failed = L.append_atomic(new, None, CONTRACT, unit="part")
    assert rows(acc.select("symbol")) == [("b",)]
    assert rows(failed.select("part", "bad_rows", "reasons")) == [(1, 1, ["duplicate_key"]), (2, 1, ["duplicate_key"])]


def test_prefix_load_into_an_existing_table(spark):
    data = [(i, "a", D(2024, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(10)]
    target = _rows(spark, [(0, "a", D(2024, 1, 8), 1.0)]).drop("seq")     # collides with row 7, batch 3
    acc, failed = L.append_prefix(_rows(spark, data), target, CONTRACT, unit="symbol", order="seq", batch_size=2,
                                  block_rows=3, range_key="trade_date")
    assert acc.count() == 6 and rows(failed) == [("a", 3, 4)]


def test_upsert_joins_only_the_range_it_can_change(spark):
    target = _rows(spark, [(0, "a", D(2020, 1, 1), 1.0), (0, "a", D(2024, 1, 1), 1.0), (0, "b", D(2024, 1, 2), 5.0)]) \
        .drop("seq")
    src = _rows(spark, [(1, "a", D(2024, 1, 1), 2.0), (2, "c", D(2024, 1, 3), 3.0)])
    merged, _ = L.upsert(target, src, CONTRACT, seq="seq", range_key="trade_date")
    assert [(s, d, float(p)) for s, d, p in rows(merged.select("symbol", "trade_date", "px"))] == [
        ("a", D(2020, 1, 1), 1.0), ("a", D(2024, 1, 1), 2.0), ("b", D(2024, 1, 2), 5.0), ("c", D(2024, 1, 3), 3.0)]
    none, _ = L.upsert(target, src.limit(0), CONTRACT, seq="seq", range_key="trade_date")
    assert none.count() == 3


def test_target_rows_look_their_date_up_without_a_search(spark):
    """A target row costs the same whether the new rows bear one date or thousands of them."""
    days = [D(1, 1, 3), D(1883, 11, 18), D(1969, 12, 31), D(1970, 1, 1), D(9999, 12, 31),
            *[D(2024, 1, 1) + dt.timedelta(days=3 * i) for i in range(4000)]]
    new = spark.createDataFrame([(d,) for d in [*days, *days[:9], None]], "trade_date date")
    near = {d + dt.timedelta(days=k) for d in days if d.year < 9999 for k in (-1, 0, 1, 64)} | {D(9999, 12, 30), D(9999, 12, 31)}
    target = spark.createDataFrame([(d,) for d in [*sorted(near), None]], "trade_date date")
    found = target.filter(L._on_dates(new, "trade_date"))
    assert [d for d, in rows(found)] == sorted(days)
    assert target.filter(L._on_dates(new.limit(0), "trade_date")).count() == 0
    assert target.filter(L._on_dates(new.filter("trade_date is null"), "trade_date")).count() == 0
    assert "array_contains" not in found._jdf.queryExecution().optimizedPlan().toString().lower()


def test_load_report_and_code_list(spark):
    offered = spark.createDataFrame([("a",), ("a",), ("b",)], "symbol string")
    got = rows(L.load_report(offered, offered.where("symbol = 'b'"), "symbol"))
    assert got == [("a", 2, 0, 2), ("b", 1, 1, 0)]
    codes = spark.createDataFrame([("1",), ("2",), ("2",)], "code string")
    feed = spark.createDataFrame([("2", 5), ("3", 6)], "code string, v int")
    assert rows(L.on_list(feed, codes)) == [("2", 5)] and rows(L.listed_without_data(codes, feed)) == [("1",)]


def test_bad_index_date_raises_and_the_old_table_stays(spark, tmp_path):
    import pytest
    from ledgerframe.plans import etl as E
    path, staging = str(tmp_path / "index"), str(tmp_path / "staging")
    cols = "trade_date string, index_value double, pb double, pb_weighted double, pb_median double, market string"
    good = spark.createDataFrame([("2024-01-02", 1.0, 1.0, 1.0, 1.0, "SH")], cols)
    L.full_refresh(E.ingest_index_valuation(good), path, staging)
    bad = good.union(spark.createDataFrame([("N/A", 1.0, 1.0, 1.0, 1.0, "SZ")], cols))
    with pytest.raises(Exception, match="strict parsing failed"):
        L.full_refresh(E.ingest_index_valuation(bad), path, staging)
    assert spark.read.parquet(path).count() == 1
    big = good.withColumn("index_value", F.lit(1e12))
    L.full_refresh(E.ingest_index_valuation(big), path, staging)   # a failed insert leaves it empty
    assert spark.read.parquet(path).count() == 0


def test_empty_load(spark):
    empty = _rows(spark, [])
    acc, failed = L.append_atomic(empty, None, CONTRACT, unit="symbol")
    assert acc.count() == 0 and failed.count() == 0


def test_period_spine_and_missing(spark):
    spine = L.period_spine(spark, 2009, 2025)
    assert spine.count() == 34 == len(L.report_periods(2009, 2025))
    present = spark.createDataFrame([("20090630",), ("20250630",)], "report_date string")
    assert L.missing_periods(present, spine).count() == 32


def test_venue_symbols_and_rounding(spark):
    df = spark.createDataFrame([("600000",), ("000001",), ("830001",), ("68",), ("301999",)], "code string")
    got = rows(C.venue_symbols(df, "code"))
    assert got == [("000001", "sz000001"), ("301999", "sz301999"), ("600000", "sh600000")]
    r = spark.createDataFrame([(2.5, 0.125, "12", "--", "2024-01-02", "N/A")],
                              "a double, b double, n string, m string, d string, e string")
    r = C.round_to_scale(r, {"a": 0, "b": 2})
    r = C.lenient_numeric(r, ["n", "m"])
    r = C.strict_date(C.lenient_date(r, ["d"]), ["e"])
    x = r.first()
    assert (x["a"], x["b"], x["n"], x["m"], x["d"], x["e"], x["_bad_date"]) == \
        (2.0, 0.12, 12.0, None, D(2024, 1, 2), None, True)


def test_nan_to_null_and_per_share(spark):
    df = spark.createDataFrame([(float("nan"), 15.0)], "a double, b double")
    x = C.per_share(C.nan_to_null(df, ["a"]), ["b"]).first()
    assert x["a"] is None and x["b"] == 1.5


def test_vendor_headers_are_renamed(spark):
    from ledgerframe.functions import vendor as V
    from ledgerframe.plans import etl as E
    df = spark.createDataFrame([("20240630", 1, "600000", "2024-07-01", "12.5")],
                               "report_date string, seq long, `代码` string, `除权除息日` string, `送转股份-送转总比例` string")
    renamed = C.rename_columns(df, V.DIVIDEND_HEADERS)
    assert renamed.columns == ["report_date", "seq", "symbol", "ex_dividend_date", "total_bonus_split"]
    cleaned = E.C.per_share(E.C.lenient_numeric(renamed, ["total_bonus_split"]), ["total_bonus_split"], 10)
    assert cleaned.first()["total_bonus_split"] == 1.25
