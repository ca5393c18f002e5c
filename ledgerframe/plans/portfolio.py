"""Positions, P&L and NAV from a trade blotter, close prices and a business calendar.

Inputs (FIXTURES.md section 2):
  trades(orderid, tradedate, ticker, action, shares, tradeprice)
  closeprices(closedate, ticker, closeprice, volume)   unique (closedate, ticker)
  calendar(closedate, previous_business_date)          one row per day

Functions that need per-ticker-day trade sums accept an optional ``summary``
(``operators.tradeday.daily_trade_summary``); pass the same object to several
functions and Spark computes it once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window, functions as F

from ledgerframe.operators.ordered import running_sum
from ledgerframe.operators.tradeday import daily_trade_summary

# Starting NAV of the portfolio.
START_NAV = 100000


def _summary(trades: DataFrame, summary: DataFrame | None) -> DataFrame:
    return summary if summary is not None else daily_trade_summary(trades)


def _prev_prices(closeprices: DataFrame) -> DataFrame:
    return closeprices.select(F.col("closedate").alias("previous_business_date"), "ticker",
                              F.col("closeprice").alias("prev_close"))


def _priced_with_prev(closeprices: DataFrame, calendar: DataFrame) -> DataFrame:
    """closedate, ticker, closeprice, prev_close: inner joins, so a ticker-day whose
    previous business day has no price is dropped (as in the reference)."""
    cp = closeprices.select("closedate", "ticker", "closeprice")
    return (cp.join(calendar, "closedate")
            .join(_prev_prices(closeprices), ["previous_business_date", "ticker"])
            .select("closedate", "ticker", "closeprice", "prev_close"))


def to_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


# ------------------------------------------------------------------ K20 .. K24

def price_with_prev_detail(closeprices: DataFrame, calendar: DataFrame,
                           ticker: str, closedate) -> DataFrame:
    """One ticker-day with its calendar row and the previous business day's price.
    Both dates are known before the prices are read (the earlier one is a scalar
    subquery over the calendar), so both sides are filters that reach the scan."""
    day, of_ticker = F.lit(to_date(closedate)), F.col("ticker") == ticker
    row = calendar.filter(F.col("closedate") == day)
    before = row.select(F.max("previous_business_date")).scalar()
    cp = closeprices.filter(of_ticker & (F.col("closedate") == day))
    prev = closeprices.filter(of_ticker & (F.col("closedate") == before)).select(
        F.col("closedate").alias("previous_business_date"), "ticker",
        F.col("closeprice").alias("prev_closeprice"), F.col("volume").alias("prev_volume"))
    return (cp.join(row, "closedate").join(prev, ["previous_business_date", "ticker"])
            .select("closedate", "ticker", "closeprice", "volume", "previous_business_date",
                    "prev_closeprice", "prev_volume"))


def calendar_prices_trades(calendar: DataFrame, closeprices: DataFrame, trades: DataFrame) -> DataFrame:
    """Calendar x price rows, left-joined to that day's trades of the ticker. A plain
    equi-join: Spark broadcasts the prices when they are small, and splits hot
    ticker-days otherwise."""
    priced = calendar.join(closeprices.select("closedate", "ticker", "closeprice"), "closedate")
    priced = priced.withColumnRenamed("ticker", "_ticker")
    return priced.join(trades, (trades.tradedate == priced.closedate) & (trades.ticker == priced._ticker), "left") \
        .select("closedate", "previous_business_date", "closeprice",
                "orderid", "tradedate", "ticker", "action", "shares", "tradeprice")


def previous_close(closeprices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Closedate, closeprice, ticker, prev_close (previous business day, same ticker)."""
    return _priced_with_prev(closeprices, calendar).select("closedate", "closeprice", "ticker", "prev_close")


def trade_activity(calendar: DataFrame, trades: DataFrame,
                   summary: DataFrame | None = None) -> DataFrame:
    """Number of trades and shares traded on every calendar day (0 when none)."""
    per_day = _summary(trades, summary).groupBy(F.col("tradedate").alias("closedate")).agg(
        F.sum("n_trades").alias("n"), F.sum("shares").alias("sh"))
    return calendar.select("closedate").join(per_day, "closedate", "left").select(
        "closedate",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("no_trades"),
        F.coalesce("sh", F.lit(0)).cast("bigint").alias("no_shares"))


def trades_to_date(calendar: DataFrame, trades: DataFrame, closedate) -> DataFrame:
    """Every trade on or before one calendar date (no rows when the calendar does
    not hold the date). The calendar lookup is a scalar subquery, so the trade scan is
    a plain filter: no join, no shuffle."""
    day = calendar.filter(F.col("closedate") == F.lit(to_date(closedate))).select(F.max("closedate")).scalar()
    return (trades.filter(F.col("tradedate") <= day)
            .select(day.alias("closedate"), "orderid", "tradedate", "ticker", "action", "shares", "tradeprice"))


# ------------------------------------------------------------------ K25 positions

def net_positions(trades: DataFrame, calendar: DataFrame,
                  summary: DataFrame | None = None, with_last_tradedate: bool = False) -> DataFrame:
    """Cumulative signed shares per (calendar day, ticker), Sell negative
    (case-sensitive), for every calendar day on/after the ticker's first trade.

    The literal form joins calendar to trades on ``tradedate <= closedate`` (a nested
    loop, days x trades). Here: net shares per ticker-day, unioned with a day spine,
    running sum per ticker (RANGE frame, so same-day trades count), spine rows kept.
    Trades dated before the calendar start still count from its first day.
    """
    s = _summary(trades, summary)
    net = s.select(F.col("tradedate").alias("closedate"), "ticker",
                   F.col("net_shares").alias("delta"), F.col("tradedate").alias("td"),
                   F.lit(False).alias("is_day"))
    first = s.groupBy("ticker").agg(F.min("tradedate").alias("first_day"))
    lo = calendar.select(F.min("closedate")).scalar()
    hi = calendar.select(F.max("closedate")).scalar()
    spine_dates = (first.withColumn("start", F.greatest(F.col("first_day"), lo))
                   .filter(F.col("start") <= hi)
                   .select("ticker", F.explode(F.sequence(F.col("start"), hi)).alias("closedate")))
    # keep only real calendar rows (the calendar may be sparse in general)
    spine = spine_dates.join(F.broadcast(calendar.select("closedate")), "closedate").select(
        "closedate", "ticker", F.lit(None).cast("bigint").alias("delta"),
        F.lit(None).cast("date").alias("td"), F.lit(True).alias("is_day"))
    w = Window.partitionBy("ticker").orderBy("closedate").rangeBetween(Window.unboundedPreceding, 0)
    out = (net.unionByName(spine)
           .withColumn("quantity", F.sum("delta").over(w))
           .withColumn("last_tradedate", F.max("td").over(w))
           .filter("is_day"))
    cols = ["closedate", "ticker", "quantity"] + (["last_tradedate"] if with_last_tradedate else [])
    return out.select(*cols)


# ------------------------------------------------------------------ K26 .. K29 P&L

def position_pnl(positions: DataFrame, calendar: DataFrame, closeprices: DataFrame) -> DataFrame:
    """Per (day, ticker) quantity, both prices and (close - prev close) * quantity."""
    j = positions.join(_priced_with_prev(closeprices, calendar), ["closedate", "ticker"])
    return j.select("closedate", "ticker", "quantity",
                    F.col("prev_close").alias("previous_day_closeprice"),
                    F.col("closeprice").alias("todays_closeprice"),
                    ((F.col("closeprice") - F.col("prev_close")) * F.col("quantity")).alias("position_pnl"))


def trading_pnl(trades: DataFrame, closeprices: DataFrame,
                summary: DataFrame | None = None) -> DataFrame:
    """Sum over trades of (close that day - trade price) * signed shares, per
    (tradedate, ticker); equals close * net_shares - signed_notional of the summary."""
    s = _summary(trades, summary)
    cp = closeprices.select(F.col("closedate").alias("tradedate"), "ticker", "closeprice")
    return s.join(cp, ["tradedate", "ticker"]).select(
        "tradedate", "ticker",
        (F.col("closeprice") * F.col("net_shares") - F.col("signed_notional")).alias("trading_pnl"))


def trading_pnl_by_day(trades: DataFrame, closeprices: DataFrame,
                       summary: DataFrame | None = None) -> DataFrame:
    """Trade P&L per trade date."""
    return trading_pnl(trades, closeprices, summary).groupBy("tradedate").agg(
        F.sum("trading_pnl").alias("trading_pnl"))


def position_pnl_by_day(positions: DataFrame, calendar: DataFrame, closeprices: DataFrame) -> DataFrame:
    """Position P&L per close date."""
    return position_pnl(positions, calendar, closeprices).groupBy("closedate").agg(
        F.sum("position_pnl").alias("position_pnl"))


def daily_pl(positions: DataFrame, trades: DataFrame, calendar: DataFrame,
             closeprices: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """Position P&L + trade P&L for every calendar day, 0 where missing.

    Same-day trades are counted in both terms, as the reference does (its positions
    already include trades dated <= the close date).
    """
    pos = position_pnl_by_day(positions, calendar, closeprices)
    trd = trading_pnl_by_day(trades, closeprices, summary).withColumnRenamed("tradedate", "closedate")
    zero = F.lit(0).cast("decimal(2,0)")
    return (calendar.select("closedate").join(pos, "closedate", "left").join(trd, "closedate", "left")
            .select("closedate",
                    (F.coalesce("position_pnl", zero) + F.coalesce("trading_pnl", zero)).alias("pl")))


def nav(pl: DataFrame, start: int = START_NAV) -> DataFrame:
    """Start + running sum of pl over close dates (two-level prefix sum)."""
    out = running_sum(pl.select("closedate", "pl"), "closedate", "pl", "_cum")
    return out.select("closedate", (F.col("_cum") + F.lit(start)).alias("nav"))


# ------------------------------------------------------------------ K31 .. K33, K46

def calendar_month_bounds(calendar: DataFrame) -> DataFrame:
    """First and last day-of-month (as two-digit text) per (month, year)."""
    d = F.col("closedate")
    return calendar.groupBy(F.date_format(d, "MM").alias("month"), F.date_format(d, "yyyy").alias("year")).agg(
        F.min(F.date_format(d, "dd")).alias("month_start_day"),
        F.max(F.date_format(d, "dd")).alias("month_end_day"))


def _ret(close: str = "closeprice", prev: str = "prev_close"):
    return F.try_divide((F.col(close) - F.col(prev)).cast("double"), F.col(prev).cast("double"))


def daily_returns(calendar: DataFrame, closeprices: DataFrame) -> DataFrame:
    """(close - prev) / prev per ticker-day, previous business day from the calendar."""
    return _priced_with_prev(closeprices, calendar).select("closedate", "ticker", _ret().alias("daily_return"))


def ticker_contributions(positions: DataFrame, calendar: DataFrame, closeprices: DataFrame) -> DataFrame:
    """Position P&L summed per ticker (trade P&L is not included, as in the reference)."""
    return position_pnl(positions, calendar, closeprices).groupBy("ticker").agg(
        F.sum("position_pnl").alias("ticker_pl"))


def avg_change_by_ticker_month(calendar: DataFrame, closeprices: DataFrame) -> DataFrame:
    """Mean of close/prev - 1 per (ticker, month-of-year); years are merged."""
    j = _priced_with_prev(closeprices, calendar)
    chg = F.try_divide(F.col("closeprice").cast("double"), F.col("prev_close").cast("double")) - 1
    return j.groupBy("ticker", F.date_format("closedate", "MM").alias("month")).agg(
        F.avg(chg).alias("avg_percent_change"))
