"""Target table contracts (the reference's DDL: types, NOT NULL, VARCHAR lengths, PK)."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, LongType, StringType, StructField,
                               StructType, TimestampType)

from ledgerframe.operators.contract import Contract


def _s(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


D = DecimalType

# Column names, types, NOT NULL, lengths and keys of the five target tables.

MARKET_INDEX = Contract(_s(
    ("trade_date", DateType(), False), ("market", StringType(), False),
    ("index_value", D(10, 2), True), ("pb", D(10, 4), True), ("pb_weighted", D(10, 4), True),
    ("pb_median", D(10, 4), True), ("update_time", TimestampType(), False),
), pk=["trade_date", "market"], lengths={"market": 10})

STOCK_DIVIDEND = Contract(_s(
    ("symbol", StringType(), False), ("ex_dividend_date", DateType(), False), ("name", StringType(), True),
    *[(c, D(9, 4), True) for c in ("total_bonus_split", "bonus_share", "split_share", "cash_dividend",
                                   "dividend_yield", "eps", "bps", "capital_reserve",
                                   "undistributed_profit", "net_profit_growth")],
    ("total_shares", LongType(), True), ("proposal_date", DateType(), True), ("record_date", DateType(), True),
    ("progress", StringType(), True), ("latest_announcement", DateType(), True),
    ("update_time", TimestampType(), False),
), pk=["symbol", "ex_dividend_date"], lengths={"symbol": 10, "name": 100, "progress": 50})

STOCK_SHARE_CAP = Contract(_s(
    ("symbol", StringType(), False), ("data_date", DateType(), False),
    ("close", D(15, 4), True), ("change_pct", D(15, 6), True),
    ("total_mv", D(20, 2), True), ("circulating_mv", D(20, 2), True),
    ("total_share", D(38, 0), True), ("float_share", D(38, 0), True),
    *[(c, D(15, 4), True) for c in ("pe_ttm", "pe_static", "pb", "peg", "pcf", "ps")],
    ("update_time", TimestampType(), False),
), pk=["symbol", "data_date"], lengths={"symbol": 10})

STOCK_DAILY = Contract(_s(
    ("symbol", StringType(), False), ("trade_date", DateType(), False),
    *[(c, D(9, 4), True) for c in ("open", "high", "low", "close")],
    ("volume", D(15, 2), True), ("amount", D(20, 2), True), ("turnover", D(9, 6), True),
    ("update_time", TimestampType(), False),
), pk=["symbol", "trade_date"], lengths={"symbol": 10})

STOCK_VALUATION = Contract(_s(
    ("symbol", StringType(), False), ("trade_date", DateType(), False),
    *[(c, D(18, 6), True) for c in ("pe", "pe_ttm", "pb", "ps", "ps_ttm", "dv_ratio", "dv_ttm")],
    ("total_mv", D(20, 2), True), ("update_time", TimestampType(), False),
), pk=["symbol", "trade_date"], lengths={"symbol": 10})
