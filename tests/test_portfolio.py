"""Positions / P&L / NAV / risk on hand-made rows (reference quirks Q1, Q2, Q6, Q13, Q14)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from suite_helpers import rows
from ledgerframe.plans import portfolio as P
from ledgerframe.plans import risk as R
from ledgerframe.sources.bridge import calendar_between

D = dt.date
TRADES = "orderid long, tradedate date, ticker string, action string, shares long, tradeprice decimal(12,2)"
PRICES = "closedate date, ticker string, closeprice decimal(12,2), volume long"


def _cal(spark, lo, hi):
    return calendar_between(spark.createDataFrame([(lo, hi)], "lo date, hi date"))


def test_calendar_previous_business_day(spark):
    cal = {r["closedate"]: r["previous_business_date"] for r in _cal(spark, D(2024, 1, 1), D(2024, 1, 8)).collect()}
    assert cal[D(2024, 1, 1)] == D(2023, 12, 29)   # Monday -> Friday
    assert cal[D(2024, 1, 7)] == D(2024, 1, 5)     # Sunday -> Friday
    assert cal[D(2024, 1, 6)] == D(2024, 1, 5)     # Saturday -> Friday
    assert cal[D(2024, 1, 3)] == D(2024, 1, 2)


def test_positions_sell_case_and_spine(spark):
    t = spark.createDataFrame([
        (1, D(2024, 1, 2), "A", "Buy", 10, Decimal("1.00")),
        (2, D(2024, 1, 3), "A", "Sell", 4, Decimal("1.00")),
        (3, D(2024, 1, 3), "A", "sell", 1, Decimal("1.00")),   # lower-case counts as a buy
        (4, D(2024, 1, 4), "A", "Sell", 7, Decimal("1.00")),   # back to zero: row kept
        (5, D(2023, 12, 30), "B", "Buy", 5, Decimal("1.00")),  # before the calendar start
    ], TRADES)
    cal = _cal(spark, D(2024, 1, 1), D(2024, 1, 5))
    got = rows(P.net_positions(t, cal))
    assert got == [
        (D(2024, 1, 1), "B", 5), (D(2024, 1, 2), "A", 10), (D(2024, 1, 2), "B", 5),
        (D(2024, 1, 3), "A", 7), (D(2024, 1, 3), "B", 5), (D(2024, 1, 4), "A", 0),
        (D(2024, 1, 4), "B", 5), (D(2024, 1, 5), "A", 0), (D(2024, 1, 5), "B", 5)]


def test_daily_pl_counts_same_day_trades_twice(spark):
    # Q1: a buy at 10 closing at 12 on the trade day earns (12-10)*1 trade P&L, and the
    # position (already including the trade) also earns (12 - prev close 11) * 1.
    t = spark.createDataFrame([(1, D(2024, 1, 3), "A", "Buy", 1, Decimal("10.00"))], TRADES)
    cp = spark.createDataFrame([(D(2024, 1, 2), "A", Decimal("11.00"), 1),
                                (D(2024, 1, 3), "A", Decimal("12.00"), 1)], PRICES)
    cal = _cal(spark, D(2024, 1, 2), D(2024, 1, 3))
    pos = P.net_positions(t, cal)
    pl = {r["closedate"]: r["pl"] for r in P.daily_pl(pos, t, cal, cp).collect()}
    assert pl == {D(2024, 1, 2): Decimal("0"), D(2024, 1, 3): Decimal("3.00")}
    nav = {r["closedate"]: r["nav"] for r in P.nav(P.daily_pl(pos, t, cal, cp)).collect()}
    assert nav[D(2024, 1, 3)] == Decimal("100003.00")


def test_trade_pnl_missing_price_and_case(spark):
    # Q13/Q14: tickers unpriced on the last date drop out; 'sell' is a sale here (Q2)
    t = spark.createDataFrame([(1, D(2024, 1, 2), "A", "sell", 2, Decimal("5.00")),
                               (2, D(2024, 1, 2), "B", "Buy", 1, Decimal("5.00"))], TRADES)
    cp = spark.createDataFrame([(D(2024, 1, 3), "A", Decimal("6.00"), 1),
                                (D(2024, 1, 2), "B", Decimal("6.00"), 1)], PRICES)
    got = rows(R.trade_pnl_as_of_last_price(t, cp).select("orderid", "trade_pnl"))
    assert got == [(1, Decimal("-2.00"))]


def test_drawdown_with_negative_nav(spark):
    nav = spark.createDataFrame([(D(2024, 1, 1), Decimal("100")), (D(2024, 1, 2), Decimal("-50")),
                                 (D(2024, 1, 3), Decimal("120"))], "closedate date, nav decimal(38,2)")
    dd = {r["closedate"]: (r["peak_nav"], r["drawdown"]) for r in R.drawdown_series(nav).collect()}
    assert dd[D(2024, 1, 2)] == (Decimal("100.00"), -1.5)
    assert dd[D(2024, 1, 3)] == (Decimal("120.00"), 0.0)
    assert R.worst_drawdown(nav).first()["closedate"] == D(2024, 1, 2)


def test_zero_nav_gives_null_return(spark):
    nav = spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i), Decimal(0 if i == 0 else 5))
                                 for i in range(31)], "closedate date, nav decimal(38,2)")
    r = R.rolling_returns(nav).filter(F.col("closedate") == D(2024, 1, 30)).first()
    assert r["ret_30d"] is None                   # lag 29 rows back is the zero NAV
    assert R.rolling_returns(nav).filter(F.col("ret_90d").isNotNull()).count() == 0


def test_single_price_ticker_has_no_return(spark):
    cp = spark.createDataFrame([(D(2024, 1, 3), "A", Decimal("6.00"), 1)], PRICES)
    cal = _cal(spark, D(2024, 1, 1), D(2024, 1, 5))
    assert P.daily_returns(cal, cp).count() == 0
    assert R.zscore(P.daily_returns(cal, cp)).count() == 0


def test_largest_move_needs_previous_calendar_day(spark):
    # Q6: the day after a missing NAV row disappears
    pl = spark.createDataFrame([(D(2024, 1, 2), Decimal("50")), (D(2024, 1, 4), Decimal("-90"))],
                               "closedate date, pl decimal(38,2)")
    nav = spark.createDataFrame([(D(2024, 1, 1), Decimal("1000")), (D(2024, 1, 2), Decimal("1050"))],
                                "closedate date, nav decimal(38,2)")
    r = R.largest_daily_move(pl, nav).first()
    assert r["closedate"] == D(2024, 1, 2) and abs(r["daily_return"] - 0.05) < 1e-12


def test_empty_trades(spark):
    t = spark.createDataFrame([], TRADES)
    cal = _cal(spark, D(2024, 1, 1), D(2024, 1, 3))
    assert P.net_positions(t, cal).count() == 0
    assert P.trade_activity(cal, t).filter("no_trades = 0").count() == 3


def test_sub_cent_prices_are_exact(spark):
    # 100 shares bought at 10.1299, close 11.0000
    t = spark.createDataFrame([(1, D(2024, 1, 3), "A", "Buy", 100, Decimal("10.1299"))],
                              TRADES.replace("decimal(12,2)", "decimal(12,4)"))
    cp = spark.createDataFrame([(D(2024, 1, 3), "A", Decimal("11.0000"), 1)],
                               PRICES.replace("decimal(12,2)", "decimal(12,4)"))
    assert P.trading_pnl(t, cp).first()["trading_pnl"] == Decimal("87.01")


def test_notional_is_exact_at_any_scale_and_sign(spark):
    from ledgerframe.operators.tradeday import daily_trade_summary
    for kind in ("decimal(12,6)", "decimal(20,6)"):  # summed as integers, and as decimals
        t = spark.createDataFrame(
            [(i, D(2024, 1, 3), "A", "Sell" if i % 2 else "Buy", 10**5 + i, Decimal(999999 - i) / 10**6 + i)
             for i in range(40)] + [(99, D(2024, 1, 4), "A", "Sell", 3, Decimal("0.000001"))],
            TRADES.replace("decimal(12,2)", kind))
        got = {r["tradedate"].day: r["signed_notional"] for r in daily_trade_summary(t).collect()}
        want = sum((-1) ** i * (10**5 + i) * (Decimal(999999 - i) / 10**6 + i) for i in range(40))
        assert got == {3: want, 4: Decimal("-0.000003")}


def test_prices_must_be_decimal(spark):
    import pytest
    from ledgerframe.operators.tradeday import daily_trade_summary
    t = spark.createDataFrame([], TRADES.replace("decimal(12,2)", "double"))
    with pytest.raises(TypeError):
        daily_trade_summary(t)


def test_prices_without_trades_and_days_without_trades(spark):
    t = spark.createDataFrame([(1, D(2024, 1, 2), "A", "Buy", 5, Decimal("1.00"))], TRADES)
    cp = spark.createDataFrame([(D(2024, 1, 2), "A", Decimal("1.00"), 1), (D(2024, 1, 2), "B", Decimal("2.00"), 1),
                                (D(2024, 1, 3), "A", Decimal("3.00"), 1)], PRICES)
    cal = _cal(spark, D(2024, 1, 2), D(2024, 1, 3))
    got = rows(P.calendar_prices_trades(cal, cp, t).select("closedate", "closeprice", "orderid")
               .fillna({"orderid": -1}))
    assert got == [(D(2024, 1, 2), Decimal("1.00"), 1), (D(2024, 1, 2), Decimal("2.00"), -1),
                   (D(2024, 1, 3), Decimal("3.00"), -1)]
    assert rows(P.trade_activity(cal, t)) == [(D(2024, 1, 2), 1, 5), (D(2024, 1, 3), 0, 0)]
