"""Registered load-job and sector-panel queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerframe.functions import schemas as S
from ledgerframe.functions.output import comparable
from ledgerframe.operators import ledger
from ledgerframe.operators.contract import split_contract
from ledgerframe.operators.loads import full_refresh_rejects, listed_without_data, on_list
from ledgerframe.plans import etl as E
from ledgerframe.plans import sectors as Z
from ledgerframe.sources import bridge, feeds


# Parameters of the increments: several batches and several numbering blocks per symbol.
SMALL_BATCH, SMALL_BLOCK = 2, 2048
PANEL_SYMBOLS = ["0", "1", "7", "13", "42"]


def _q(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(spark, sf_dir))
    return run


def _changes(spark, d):
    return Z.load_sector_changes(bridge.stock_sector(spark, d))


def _panel(spark, d):
    # end = last change date (the reference's default "today" is not reproducible)
    return Z.sector_code_panel(_changes(spark, d), end=F.max("start_date"))


def _failed(df: DataFrame) -> DataFrame:
    return df.select("symbol", "bad_rows", F.array_join("reasons", ";").alias("reasons"))


def _valuation_rejects(spark, d):
    _, rejects = split_contract(E.clean_valuation(feeds.valuation_feed(spark, d)), S.STOCK_VALUATION)
    return rejects.select("seq", "symbol", "trade_date", "reason")


def _halves(feed):
    """(what the target holds, the increment) of a feed."""
    return feeds.first_half(feed), feeds.second_half(feed)


def _daily_increment(spark, d):
    old, new = _halves(feeds.daily_bar_feed(spark, d))
    return E.ingest_daily_bars(new, target=E.ingest_daily_bars(old)[0])


def _cap_increment(spark, d):
    old, new = _halves(feeds.share_capital_feed(spark, d))
    return E.ingest_share_capital(new, target=E.ingest_share_capital(old)[0])


def _valuation_increment(spark, d):
    """Listed codes only, small batches and blocks: symbols keep batches before a bad one."""
    feed = on_list(feeds.valuation_feed(spark, d), feeds.code_list(spark, d))
    old, new = _halves(feed)
    return E.ingest_valuation(new, target=E.ingest_valuation(old)[0], batch_size=SMALL_BATCH, block_rows=SMALL_BLOCK)


def _dividend_merge(spark, d):
    old, new = _halves(feeds.dividend_feed(spark, d))
    return E.ingest_dividends(new, target=E.ingest_dividends(old)[0])


def _ledger(spark, d):
    """A run that loaded half of the files, then one that is offered all, some corrected."""
    feed = feeds.landed_files(feeds.daily_bar_feed(spark, d))
    loaded = ledger.contents(feeds.first_half(feed), "daily_bars", "file")
    offered = feeds.corrected(feed, "close")
    return ledger.compare(offered, loaded, "daily_bars", "file").select(F.col("unit").alias("file"), "rows", "status")


def _wide_panel(spark, d):
    wide = Z.pivot_panel(_panel(spark, d), "industry_code", PANEL_SYMBOLS)
    return wide.select("date", *[F.col(f"`{s}`").alias(f"symbol_{s}") for s in PANEL_SYMBOLS])


QUERIES = {
    "sector_changes": _q(_changes),
    "sector_change_conflicts": _q(lambda s, d: Z.change_conflicts(bridge.raw_sector_changes(s, d))),
    "sector_code_panel": _q(_panel),
    "sector_panel_wide": _q(_wide_panel),
    "sector_and_industry": _q(lambda s, d: Z.sector_and_industry(_panel(s, d), bridge.sector_mapping(s, d))),
    "listed_codes": _q(lambda s, d: E.listed_codes(feeds.code_list(s, d))),
    "listed_without_data": _q(lambda s, d: listed_without_data(
        E.listed_codes(feeds.code_list(s, d)), feeds.valuation_feed(s, d))),
    "index_feed": _q(lambda s, d: feeds.index_feed(s, d)),
    "ingest_index_valuation": _q(lambda s, d: E.ingest_index_valuation(E.index_rows(feeds.index_frames(s, d)))),
    "index_load_rejects": _q(lambda s, d: full_refresh_rejects(
        E.clean_index(feeds.index_feed(s, d, oversize="SZ")), S.MARKET_INDEX)),
    "index_load_report": _q(lambda s, d: E.report_index(feeds.index_feed(s, d, oversize="SZ"))),
    "valuation_rejects": _q(_valuation_rejects),
    "ingest_valuation": _q(lambda s, d: E.ingest_valuation(feeds.valuation_feed(s, d))[0]),
    "valuation_failed_batches": _q(lambda s, d: E.ingest_valuation(feeds.valuation_feed(s, d))[1]),
    "valuation_increment": _q(lambda s, d: _valuation_increment(s, d)[0]),
    "valuation_increment_failed_batches": _q(lambda s, d: _valuation_increment(s, d)[1]),
    "valuation_load_report": _q(lambda s, d: E.report_valuation(feeds.valuation_feed(s, d), batch_size=SMALL_BATCH)),
    "ingest_daily_bars": _q(lambda s, d: E.ingest_daily_bars(feeds.daily_bar_feed(s, d))[0]),
    "daily_bar_failed_symbols": _q(lambda s, d: _failed(E.ingest_daily_bars(feeds.daily_bar_feed(s, d))[1])),
    "daily_bar_increment": _q(lambda s, d: _daily_increment(s, d)[0]),
    "daily_bar_increment_failed_symbols": _q(lambda s, d: _failed(_daily_increment(s, d)[1])),
    "load_ledger": _q(_ledger),
    "daily_bar_load_report": _q(lambda s, d: E.report_daily_bars(feeds.daily_bar_feed(s, d))),
    "ingest_share_capital": _q(lambda s, d: E.ingest_share_capital(feeds.share_capital_feed(s, d))[0]),
    "share_capital_failed_symbols": _q(lambda s, d: _failed(E.ingest_share_capital(feeds.share_capital_feed(s, d))[1])),
    "share_capital_increment": _q(lambda s, d: _cap_increment(s, d)[0]),
    "share_capital_load_report": _q(lambda s, d: E.report_share_capital(feeds.share_capital_feed(s, d))),
    "ingest_dividends": _q(lambda s, d: E.ingest_dividends(feeds.dividend_feed(s, d))[0]),
    "dividend_rejects": _q(lambda s, d: E.ingest_dividends(feeds.dividend_feed(s, d))[1]
                           .select("report_date", "seq", "symbol", "ex_dividend_date", "reason")),
    "dividend_merge": _q(lambda s, d: _dividend_merge(s, d)[0]),
    "dividend_load_report": _q(lambda s, d: E.report_dividends(feeds.dividend_feed(s, d))),
    "missing_dividend_periods": _q(lambda s, d: E.missing_dividend_periods(feeds.dividend_feed(s, d))),
}
