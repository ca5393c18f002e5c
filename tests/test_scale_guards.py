"""Guards for the scale properties the README claims."""

import os

import pytest
from pyspark.sql import functions as F

from tools.plans import PATTERNS

SF = "/root/testdata/sf0.001"
KEYS = ["net_positions", "daily_pl", "nav", "rolling_returns", "drawdown_series", "trades_to_date",
        "calendar_prices_trades", "trade_pnl_as_of_last_price", "trailing_30d_avg", "zscore_90d",
        "artist_track_counts", "top_genre_per_city_multi", "genre_artist_bytes_per_ms",
        "ingest_valuation", "ingest_daily_bars", "ingest_dividends", "sector_code_panel",
        "valuation_increment", "daily_bar_increment", "dividend_merge", "rep_efficiency", "revenue_extremes"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("key", KEYS)
def test_no_nested_loop_cartesian_or_udf(spark, key):
    import __spark_entry__ as E
    spark.catalog.clearCache()  # a kept frame that has been computed shows the stages it ran as
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for name in ("nested-loop", "cartesian", "python-udf"):
        assert not PATTERNS[name].search(plan), (key, name)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if PATTERNS["single-partition"].search(line):
            parent = lines[i - 1] if i else ""
            assert "Aggregate(keys=[]" in parent or "Aggregate(key=[]" in parent or "Sort [_blk" in parent, (key, parent)


def test_hot_repeated_key_in_load(spark):
    """A third of the load is copies of one key: results stay exact."""
    import datetime as dt
    from ledgerframe.operators import loads as L
    from test_loads import CONTRACT
    hot = [(i, "a", dt.date(2024, 1, 1), 1.0) for i in range(3000)]
    rest = [(10000 + i, f"s{i % 50}", dt.date(2024, 1, 2) + dt.timedelta(days=i // 50), 1.0) for i in range(6000)]
    df = spark.createDataFrame(hot + rest, "seq long, symbol string, trade_date date, px double") \
        .withColumn("update_time", F.lit(dt.datetime(2025, 1, 1)))
    acc, failed = L.append_atomic(df, None, CONTRACT, unit="symbol")
    assert acc.count() == 6000 and [r["symbol"] for r in failed.collect()] == ["a"]
    acc2, failed2 = L.append_prefix(df, None, CONTRACT, unit="symbol", order="seq", batch_size=1000)
    assert acc2.filter("symbol = 'a'").count() == 0       # the repeat is in batch 0
    merged, _ = L.upsert(None, df, CONTRACT, seq="seq")
    assert merged.count() == 6001


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_small_answers_filter_at_the_scan(spark):
    """K20 reads two ticker-days, K31 one column: their filters and projections reach the files."""
    import __spark_entry__ as E
    spark.catalog.clearCache()
    plan = E.queries()["price_with_prev_detail"](spark, SF)._jdf.queryExecution().toString()
    scans = [x for x in plan.split("== Physical Plan ==")[1].splitlines() if "FileScan" in x and "l_shipdate" in x]
    filtered = [x for x in scans if "DataFilters: [" in x and "l_shipdate" in x.split("DataFilters: [")[1].split("]")[0]]
    assert len(filtered) >= 2
    plan = E.queries()["calendar_month_bounds"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_shipdate" in plan and "l_extendedprice" not in plan


def test_hot_playlist_is_split(spark, tmp_path):
    """A third of the playlist rows on one playlist, broadcast off: the joins on the playlist split it."""
    from ledgerframe.plans import music as M
    from ledgerframe.sources.bridge import Store
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    spark.range(200).select(F.col("id").alias("playlistid")).write.parquet(f"{tmp_path}/playlist")
    n = 60_000
    spark.range(n).repartition(8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).alias("playlistid"),
                          F.col("id").alias("trackid")).write.parquet(f"{tmp_path}/playlisttrack")
    spark.range(n).select(F.col("id").alias("trackid"), F.lit("t").alias("name"), (F.col("id") % 50).alias("albumid"),
                          F.lit(1).alias("mediatypeid"), F.lit(1).alias("genreid"), F.lit("c").alias("composer"),
                          F.lit(1000).cast("long").alias("milliseconds"), F.lit(5).cast("long").alias("bytes"),
                          F.lit("1.00").cast("decimal(12,2)").alias("unitprice")).write.parquet(f"{tmp_path}/track")
    read = lambda t: spark.read.parquet(f"{tmp_path}/{t}")
    album = spark.range(50).select(F.col("id").alias("albumid"), F.lit("a").alias("title"), F.lit(1).cast("long").alias("artistid"))
    artist = spark.range(2).select(F.col("id").alias("artistid"), F.lit("x").alias("name"))
    genre = spark.range(1, 2).select(F.col("id").cast("int").alias("genreid"), F.lit("g").alias("name"))
    s = Store(artist, album, genre, read("track"), read("playlist"), read("playlisttrack").distinct(), None, None, None, None)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for query in (M.playlist_tracks, M.artist_track_counts, M.genre_totals):
            df = query(s)
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            joins = [x for x in plan.splitlines() if "SortMergeJoin" in x and "playlistid" in x]
            assert any("skew=true" in x for x in joins), (query.__name__, joins)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_merge_plan_stays_small(spark):
    """The optimiser must not restate the contract for every subset of columns in a merge."""
    import time
    from ledgerframe.plans.etl_catalog import QUERIES
    sf = "/root/testdata/sf0.001"
    plain = QUERIES["ingest_dividends"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    merge = QUERIES["dividend_merge"](spark, sf)
    began = time.time()
    plan = merge._jdf.queryExecution().optimizedPlan().toString()
    assert time.time() - began < 20
    assert len(plan) < 10 * len(plain)
