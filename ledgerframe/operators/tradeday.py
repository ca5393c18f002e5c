"""Per (trade day, ticker) pre-aggregation of the trade blotter.

Every portfolio number the reference derives from trades (positions, trade P&L,
activity, close prices of the bridge) is a sum over trades of one ticker-day. Folding
trades to that grain first means the only operator that touches trade volume is a
partial (map-side) hash aggregate; everything downstream works on days x tickers rows,
a size fixed by the calendar and the instrument list rather than by the data volume.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType

# A price of at most this many digits, times a share count, fits a 64-bit integer.
_LONG_DIGITS = 12


def signed_shares(action: str = "action", shares: str = "shares",
                  case_sensitive: bool = True) -> Column:
    """Sell is negative, everything else positive.

    Positions and P&L compare ``action = 'Sell'`` case-sensitively, so a ``'sell'`` row
    counts as a buy there; trade P&L as of the last price lowers the text first.
    """
    a = F.col(action) if case_sensitive else F.lower(F.col(action))
    sell = F.lit("Sell") if case_sensitive else F.lit("sell")
    return F.when(a == sell, -F.col(shares)).otherwise(F.col(shares))


def _exact_notional(price: DecimalType, signed: Column) -> tuple[list[Column], Column]:
    """Aggregates, and the expression over them that gives sum(tradeprice * signed) exactly.

    A decimal product per trade would exceed 18 digits and make Spark allocate an object
    for each. A price that fits is therefore counted in its smallest unit (its scale says
    which), and the 64-bit products are summed as their upper and lower 32 bits, so the
    sums hold for two thousand million trades of a ticker-day. Wider prices are summed as
    decimals.
    """
    target = f"decimal(38,{price.scale})"
    if price.precision > _LONG_DIGITS:
        return [F.sum((F.col("tradeprice") * signed).cast(target)).alias("_exact")], F.col("_exact")
    units = (F.col("tradeprice") * F.lit(10 ** price.scale)).cast("bigint") * signed
    upper = F.sum(F.shiftright(units, 32)).alias("_upper")
    lower = F.sum(units.bitwiseAND(F.lit((1 << 32) - 1))).alias("_lower")
    total = F.col("_upper").cast("decimal(20,0)") * F.lit(1 << 32) + F.col("_lower")
    return [upper, lower], (total * F.lit(Decimal(1).scaleb(-price.scale))).cast(target)


def daily_trade_summary(trades: DataFrame) -> DataFrame:
    """(tradedate, ticker) -> n_trades, shares, max_price, net_shares, signed_notional.

    ``signed_notional`` = sum(tradeprice * signed shares), so for any price ``p`` the
    per-trade sum ``sum((p - tradeprice) * signed)`` equals ``p * net_shares -
    signed_notional`` exactly, at the scale that the price column declares.
    """
    price = trades.schema["tradeprice"].dataType
    if not isinstance(price, DecimalType):
        raise TypeError(f"tradeprice must be a decimal, not {price.simpleString()}: money is summed exactly")
    s = signed_shares()
    sums, notional = _exact_notional(price, s)
    return trades.groupBy("tradedate", "ticker").agg(
        F.count("orderid").alias("n_trades"),
        F.sum("shares").alias("shares"),
        F.max("tradeprice").alias("max_price"),
        F.sum(s).alias("net_shares"),
        *sums,
    ).withColumn("signed_notional", notional).drop("_upper", "_lower", "_exact")
