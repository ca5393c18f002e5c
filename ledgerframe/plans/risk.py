"""Risk and performance analytics over prices, positions, P&L and NAV.

Windows are partitioned by ticker over the ticker-day grain (bounded by days x
tickers, independent of trade volume). Portfolio-level series (NAV) use the two-level
prefix operators of ``operators.ordered`` instead of a window with no partition key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerframe.operators.ordered import global_lags, running_max
from ledgerframe.operators.tradeday import signed_shares


# Fixed values (defaults of the functions below): trailing average over 30 calendar
# days with at least 18 observations; z-score over 90 rows; volatility over 30 rows;
# rolling returns over 30 and 90 rows (lags of 29 and 89).


def _ddiv(a, b):
    """a / b in double; NULL when b is 0 (the reference's engine returns NULL)."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def top1(df: DataFrame, *order) -> DataFrame:
    """``ORDER BY .. LIMIT 1`` (TakeOrderedAndProject: per-partition top-1, then merge)."""
    return df.orderBy(*order).limit(1)


# ------------------------------------------------------------------ K18

def trailing_avg(prices: DataFrame, days: int = 30, min_obs: int = 18) -> DataFrame:
    """Mean close over the trailing ``days`` calendar days (both ends inclusive)
    per ticker, kept only where at least ``min_obs`` observations fall in the window.

    ``prices`` is (date, ticker, close), unique per (ticker, date). The reference's
    range self-join becomes a RANGE window on the day number.
    """
    day_no = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("ticker").orderBy(day_no).rangeBetween(-days, 0)
    return (prices.select("date", "close", "ticker",
                          F.avg(F.col("close").cast("double")).over(w).alias("avg_close"),
                          F.count("close").over(w).alias("_n"))
            .filter(F.col("_n") >= min_obs).drop("_n"))


def dow_prices(closeprices: DataFrame) -> DataFrame:
    return closeprices.select(F.col("closedate").alias("date"), "ticker", F.col("closeprice").alias("close"))


# ------------------------------------------------------------------ K30

def largest_daily_move(pl: DataFrame, nav: DataFrame) -> DataFrame:
    """Pl / NAV of the previous *calendar* day; the largest by absolute value."""
    prev = nav.select(F.col("closedate").alias("_prev_day"), F.col("nav").alias("_prev_nav"))
    r = pl.join(prev, F.date_sub(pl.closedate, 1) == prev._prev_day).select(
        "closedate", _ddiv(F.col("pl"), F.col("_prev_nav")).alias("daily_return"))
    return top1(r, F.abs("daily_return").desc_nulls_last(), "closedate")


# ------------------------------------------------------------------ K34 / K35

def _rolling_stats(returns: DataFrame, n: int) -> DataFrame:
    """count / mean / population stddev of daily_return over the last ``n`` rows per
    ticker (current row included); one Window node computes all three."""
    w = Window.partitionBy("ticker").orderBy("closedate").rowsBetween(-(n - 1), 0)
    r = F.col("daily_return")
    return returns.select("closedate", "ticker", "daily_return",
                          F.count(F.lit(1)).over(w).alias("cnt"),
                          F.avg(r).over(w).alias("mean"),
                          F.stddev_pop(r).over(w).alias("sd"))


def zscore(returns: DataFrame, n: int = 90) -> DataFrame:
    """z = (r - mean_n) / sd_n, only where n rows exist; sd 0 gives NULL."""
    s = _rolling_stats(returns, n).filter(F.col("cnt") >= n)
    return s.select("closedate", "ticker", "daily_return",
                    F.try_divide(F.col("daily_return") - F.col("mean"),
                                 F.nullif(F.col("sd"), F.lit(0.0))).alias("z_score"))


def largest_zscore(returns: DataFrame, n: int = 90) -> DataFrame:
    return top1(zscore(returns, n), F.abs("z_score").desc_nulls_last(), "closedate", "ticker")


def volatility(returns: DataFrame, n: int = 30) -> DataFrame:
    """closedate, ticker, std_n: population stddev over the last n rows, n rows required."""
    return (_rolling_stats(returns, n).filter(F.col("cnt") >= n)
            .select("closedate", "ticker", F.col("sd").alias(f"std_{n}")))


def risk_allocation(positions: DataFrame, closeprices: DataFrame, returns: DataFrame,
                    n: int = 30) -> DataFrame:
    """|quantity * close * std_n| per position-day, from the full volatility."""
    std = f"std_{n}"
    j = (positions.join(closeprices.select("closedate", "ticker", "closeprice"), ["closedate", "ticker"])
         .join(volatility(returns, n), ["closedate", "ticker"]))
    return j.select("closedate", "ticker", "quantity", "closeprice", std,
                    F.abs((F.col("quantity") * F.col("closeprice")).cast("double") * F.col(std))
                    .alias("risk_amount"))


def max_risk_position(positions, closeprices, returns, n: int = 30) -> DataFrame:
    return top1(risk_allocation(positions, closeprices, returns, n),
                F.col("risk_amount").desc_nulls_last(), "closedate", "ticker")


# ------------------------------------------------------------------ K36

def daily_exposure(positions: DataFrame, closeprices: DataFrame) -> DataFrame:
    """Net, gross and short notional per day."""
    j = positions.join(closeprices.select("closedate", "ticker", "closeprice"), ["closedate", "ticker"])
    v = F.col("quantity") * F.col("closeprice")
    return j.groupBy("closedate").agg(
        F.sum(v).alias("net_notional"),
        F.sum(F.abs(v)).alias("gross_notional"),
        F.sum(F.when(F.col("quantity") < 0, F.abs(v)).otherwise(F.lit(0))).alias("short_notional"))


def avg_exposure(exposure: DataFrame) -> DataFrame:
    """Average net and gross notional over days (global aggregate)."""
    return exposure.agg(F.avg(F.col("net_notional").cast("double")).alias("avg_net_notional"),
                        F.avg(F.col("gross_notional").cast("double")).alias("avg_gross_notional"))


def max_short_day(exposure: DataFrame) -> DataFrame:
    """The day with the largest short notional."""
    return top1(exposure.select("closedate", "short_notional"),
                F.col("short_notional").desc_nulls_last(), "closedate")


# ------------------------------------------------------------------ K37 .. K40

def monthly_returns(nav: DataFrame) -> DataFrame:
    """Last NAV in the month / first NAV in the month - 1 (one aggregate pass)."""
    g = nav.groupBy(F.date_format("closedate", "yyyy-MM").alias("ym")).agg(
        F.min_by("nav", "closedate").alias("nav_start"),
        F.max_by("nav", "closedate").alias("nav_end"))
    return g.select("ym", (_ddiv(F.col("nav_end"), F.col("nav_start")) - 1.0).alias("monthly_return"))


def rolling_returns(nav: DataFrame, short: int = 30, long: int = 90) -> DataFrame:
    """Nav / nav (short-1 rows back) - 1 and nav / nav (long-1 rows back) - 1."""
    lagged = global_lags(nav.select("closedate", "nav"), "closedate", "nav",
                         {"_l1": short - 1, "_l2": long - 1})
    return lagged.select("closedate", "nav",
                         (_ddiv(F.col("nav"), F.col("_l1")) - 1.0).alias(f"ret_{short}d"),
                         (_ddiv(F.col("nav"), F.col("_l2")) - 1.0).alias(f"ret_{long}d"))


def drawdown_series(nav: DataFrame) -> DataFrame:
    """Running peak NAV and nav / peak - 1."""
    p = running_max(nav.select("closedate", "nav"), "closedate", "nav", "peak_nav")
    return p.select("closedate", "nav", "peak_nav",
                    (_ddiv(F.col("nav"), F.col("peak_nav")) - 1.0).alias("drawdown"))


def worst_drawdown(nav: DataFrame) -> DataFrame:
    """The row with the lowest drawdown."""
    return top1(drawdown_series(nav), F.col("drawdown").asc_nulls_first(), "closedate")


# ------------------------------------------------------------------ K41 / K42

def trade_pnl_as_of_last_price(trades: DataFrame, closeprices: DataFrame) -> DataFrame:
    """Per trade, (close on the single latest price date - trade price) * signed
    shares, where 'sell' matches case-insensitively. Tickers without a price on that
    date are dropped. The last-price frame has one row per ticker; Spark broadcasts it
    when it is small, so that the blotter is streamed."""
    last_day = closeprices.select(F.max("closedate")).scalar()
    last = (closeprices.filter(F.col("closedate") == last_day)
            .select(F.col("ticker").alias("_t"), F.col("closeprice").alias("last_closeprice")))
    j = trades.join(last, trades.ticker == F.col("_t"))
    signed = signed_shares(case_sensitive=False)
    return j.select("orderid", "tradedate", "ticker", "shares", "action", "tradeprice", "last_closeprice",
                    ((F.col("last_closeprice") - F.col("tradeprice")) * signed).alias("trade_pnl"))


_K41_COLS = ["orderid", "tradedate", "ticker", "shares", "action", "tradeprice"]


def best_trade(trade_pnl: DataFrame) -> DataFrame:
    """Highest trade P&L (ties broken on the trade columns)."""
    return top1(trade_pnl, F.col("trade_pnl").desc_nulls_last(), *_K41_COLS)


def worst_trade(trade_pnl: DataFrame) -> DataFrame:
    """Lowest trade P&L (NULL first, as the reference's engine sorts)."""
    return top1(trade_pnl, F.col("trade_pnl").asc_nulls_first(), *_K41_COLS)

