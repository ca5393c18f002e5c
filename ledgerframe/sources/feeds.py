"""Raw vendor feeds, as landed files would hold them, derived from ``events``.

The reference pulls these frames from a market-data web API; jobs here read landed
files instead (the HTTP client is not built). For tests the landed rows are a pure
projection of the driver's ``events`` table, one feed row per event, so they grow with
it. ``seq`` is the vendor row order; text fields carry the vendor's bad values
('N/A' dates, '--' numbers).

Shape (an extension of the FIXTURES.md section 4 recipe, whose per-user codes give
every code same-day repeats and so make every all-or-nothing unit fail): the code is
``event_id mod 1000`` with a venue prefix ('830' = unlisted), the day is
``event_id div 1000`` days after 2024-01-01, so (code, day) is unique except for
deliberate repeats (purchase events of users divisible by 7 reuse the previous day).
Dates are 'N/A' for error events of users divisible by 10; one numeric field per feed
overflows its target column when value > 300. The index feed follows FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerframe.sources.tables import scan_table

OVERFLOW_ABOVE = 300


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


FEED_START = "2024-01-01"


def _code() -> Column:
    k = F.col("event_id") % 1000
    venue = (F.when(k % 5 == 0, "600").when(k % 5 == 1, "000").when(k % 5 == 2, "688")
             .when(k % 5 == 3, "301").otherwise("830"))
    return F.concat(venue, F.lpad(k.cast("string"), 3, "0"))


def _day() -> Column:
    n = F.floor(F.col("event_id") / 1000).cast("int")
    repeat = (F.col("event_type") == "purchase") & (F.col("user_id") % 7 == 0) & (n > 0)
    return F.date_add(F.lit(FEED_START).cast("date"), F.when(repeat, n - 1).otherwise(n))


def _day_text() -> Column:
    bad = (F.col("event_type") == "error") & (F.col("user_id") % 10 == 0)
    return F.when(bad, F.lit("N/A")).otherwise(_day().cast("string"))


def _txt(c: Column) -> Column:
    return c.cast("string")


def _v() -> Column:
    return F.col("value")


def _big(c: Column, factor: float) -> Column:
    return F.when(_v() > OVERFLOW_ABOVE, _v() * F.lit(factor)).otherwise(c)


def valuation_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, code, trade_date, pe, pe_ttm, pb, ps, ps_ttm, dv_ratio, dv_ttm, total_mv (text)."""
    v = _v()
    return _events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), _code().alias("code"), _day_text().alias("trade_date"),
        F.when(F.col("event_type") == "signup", F.lit("--")).otherwise(_txt(v)).alias("pe"),
        _txt(_big(v * 2, 1e11)).alias("pe_ttm"), _txt(v / 8).alias("pb"), _txt(v / 3).alias("ps"),
        _txt(v / 7).alias("ps_ttm"), _txt(v / 100).alias("dv_ratio"), _txt(v / 1000).alias("dv_ttm"),
        _txt(v * 1e8).alias("total_mv"))


def daily_bar_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, code, date (text), open, high, low, close, volume, amount, turnover (numbers)."""
    v = _v()
    return _events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), _code().alias("code"), _day_text().alias("date"),
        v.alias("open"), (v + 1).alias("high"), (v / 2).alias("low"), v.alias("close"),
        (v * 1000).alias("volume"), _big(v * 1e5, 1e17).alias("amount"), (v / 10000).alias("turnover"))


def share_capital_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, code, data_date and twelve numeric text fields."""
    v = _v()
    return _events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), _code().alias("code"), _day_text().alias("data_date"),
        _txt(v).alias("close"), _txt(v / 7).alias("change_pct"), _txt(v * 1e9).alias("total_mv"),
        _txt(v * 5e8).alias("circulating_mv"), _txt(v * 1e4 / 3).alias("total_share"),
        _txt(v * 1e4).alias("float_share"),
        F.when(F.col("event_type") == "signup", F.lit("--")).otherwise(_txt(v)).alias("pe_ttm"),
        _txt(v * 2).alias("pe_static"), _txt(v / 3).alias("pb"), _txt(v / 11).alias("peg"),
        _txt(_big(v * 3, 1e12)).alias("pcf"), _txt(v / 9).alias("ps"))


def dividend_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """report_date (yyyyMMdd), seq, code, name, four 'per 10 shares' ratios (text), six
    per-share figures (numbers), total_shares, four dates (text), progress."""
    v = _v()
    year = F.lit(2009) + F.col("user_id") % 23
    half = F.when(year < 2014, F.lit("1231")).when(F.col("event_id") % 2 == 0, F.lit("0630")).otherwise(F.lit("1231"))
    return _events(spark, sf_dir).select(
        F.concat(year.cast("string"), half).alias("report_date"),
        F.col("event_id").alias("seq"), _code().alias("code"),
        F.concat(F.lit("Name"), _code()).alias("name"),
        _txt(v).alias("total_bonus_split"), _txt(v / 2).alias("bonus_share"),
        F.when(F.col("event_type") == "signup", F.lit("--")).otherwise(_txt(v / 3)).alias("split_share"),
        _txt(v / 3).alias("cash_dividend"),
        _big(v / 5, 1e4).alias("dividend_yield"), (v / 3).alias("eps"), (v * 2).alias("bps"),
        (v / 6).alias("capital_reserve"), (v / 7).alias("undistributed_profit"), (v - 50).alias("net_profit_growth"),
        (F.col("user_id") * 1000).alias("total_shares"),
        F.date_sub(_day(), 30).cast("string").alias("proposal_date"),
        F.date_sub(_day(), 1).cast("string").alias("record_date"),
        _day_text().alias("ex_dividend_date"),
        F.col("event_type").alias("progress"),
        _day().cast("string").alias("latest_announcement"))


def index_feed(spark: SparkSession, sf_dir: str, oversize: str | None = None) -> DataFrame:
    """Tagged rows of all markets in one pass: trade_date (text), index_value, pb,
    pb_weighted, pb_median, market. The vendor's median is a given figure of its feed; the
    middle of the day's range stands for it. ``oversize`` names a market whose values do
    not fit the target column."""
    e = _events(spark, sf_dir).filter(F.col("event_type") != "error")
    t = F.col("event_type")
    market = (F.when(t == "click", "SH").when(t == "view", "SZ").when(t == "purchase", "CYB")
              .otherwise("STAR"))
    hi, lo = F.max("value"), F.min("value")
    g = e.groupBy(market.alias("market"), F.col("ts").cast("date").cast("string").alias("trade_date")).agg(
        hi.alias("index_value"), lo.alias("pb"), (hi - lo).alias("pb_weighted"),
        F.round((hi + lo) / 2, 4).alias("pb_median"))
    if oversize is not None:
        value = F.col("index_value")
        g = g.withColumn("index_value", F.when(F.col("market") == oversize, value * 1e9).otherwise(value))
    return g.select("trade_date", "index_value", "pb", "pb_weighted", "pb_median", "market")


def index_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same as the vendor lands it: one frame for each market, in the vendor's column order
    and without usable headers."""
    feed = index_feed(spark, sf_dir)
    return {m: feed.filter(F.col("market") == m).drop("market").toDF("0", "1", "2", "3", "4")
            for m in ("SH", "SZ", "CYB", "STAR")}


def landed_files(feed: DataFrame) -> DataFrame:
    """A feed with the name of the file that brought each row: ten files a day."""
    day, k = _at(feed)
    return feed.withColumn("file", F.concat(day.cast("string"), F.lit("-"), (k % 10).cast("string")))


def corrected(feed: DataFrame, column: str) -> DataFrame:
    """The feed landed again, with one figure of the codes of a tenth of some days corrected."""
    day, k = _at(feed)
    return feed.withColumn(column, F.when((day % 4 == 0) & (k % 10 == 3), F.col(column) + 1).otherwise(F.col(column)))


def code_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor's list of codes, an input of its own: some of the codes of the feeds, and
    codes of a venue prefix (605) that no feed has."""
    k = F.col("p_partkey") % 1200
    venue = (F.when(k >= 1000, "605").when(k % 5 == 0, "600").when(k % 5 == 1, "000").when(k % 5 == 2, "688")
             .when(k % 5 == 3, "301").otherwise("830"))
    code = F.concat(venue, F.lpad((k % 1000).cast("string"), 3, "0"))
    return scan_table(spark, sf_dir, "part").select(code.alias("code")).distinct()


def _at(feed: DataFrame):
    return F.floor(F.col("seq") / 1000), F.col("seq") % 1000


def first_half(feed: DataFrame) -> DataFrame:
    """The rows of every other day: what a target already holds."""
    day, _ = _at(feed)
    return feed.filter(day % 2 == 0)


def second_half(feed: DataFrame) -> DataFrame:
    """The other days, and of every tenth code some days again: the increment."""
    day, k = _at(feed)
    return feed.filter((day % 2 == 1) | ((day % 4 == 0) & (k % 10 == 3)))
