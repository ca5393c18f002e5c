"""The reference's five load jobs (A22-A26) over landed vendor feeds.

Each job is one Spark plan over all symbols / periods at once: the reference's loop
variable (symbol, batch, report period) is a column, its transaction scope a flag.
Jobs return DataFrames; writing them is the caller's choice of sink
(``operators.loads.full_refresh`` / ``merge_into_path`` / ``materialise``).
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, DecimalType

from ledgerframe.functions import cleaning as C
from ledgerframe.functions import schemas as S
from ledgerframe.functions import vendor as V
from ledgerframe.operators import loads as L
from ledgerframe.operators.contract import Contract, split_contract

LOAD_TS = _dt.datetime(2025, 1, 1)     # default load stamp (reproducible output)

# History start of the daily-bar load, rows per committed batch of the
# valuation load, and the report years of the dividend load (two periods each).
DAILY_START = "2010-01-01"
VALUATION_BATCH = 1000
REPORT_FIRST_YEAR, REPORT_LAST_YEAR = 2009, 2025

INDEX_COLUMNS = V.INDEX_COLUMNS
# The dividend figures that are quoted per ten shares.
DIVIDEND_RATIOS = ["total_bonus_split", "bonus_share", "split_share", "cash_dividend"]


def _scales(contract: Contract) -> dict[str, int]:
    """Decimal columns of a target table with their scales."""
    return {f.name: f.dataType.scale for f in contract.schema.fields if isinstance(f.dataType, DecimalType)}


def _dates(contract: Contract) -> list[str]:
    return [f.name for f in contract.schema.fields if isinstance(f.dataType, DateType)]


VALUATION_SCALES = _scales(S.STOCK_VALUATION)
CAP_SCALES = _scales(S.STOCK_SHARE_CAP)
DIVIDEND_NUMBERS = [c for c in _scales(S.STOCK_DIVIDEND) if c not in DIVIDEND_RATIOS]
DIVIDEND_DATES = _dates(S.STOCK_DIVIDEND)


def tagged_union(frames: dict[str, DataFrame], tag_col: str = "market") -> DataFrame:
    """A3: add each frame's tag as a constant column and concatenate by name."""
    return reduce(lambda a, b: a.unionByName(b),
                  [df.withColumn(tag_col, F.lit(tag)) for tag, df in frames.items()])


# ------------------------------------------------------------------ A22 index valuation

def index_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """A3 + A4: positional rename of each market's frame, tag, union."""
    return tagged_union({m: C.positional_rename(df, INDEX_COLUMNS) for m, df in frames.items()})


def clean_index(rows: DataFrame, ts=LOAD_TS) -> DataFrame:
    return C.stamp(C.strict_date(rows, ["trade_date"]), ts)


def ingest_index_valuation(rows: DataFrame, ts=LOAD_TS) -> DataFrame:
    """Drop-and-recreate load of ``market_index`` from tagged rows. An unparsed date
    raises and leaves the old table; an overflow or a repeated (trade_date, market) leaves
    the table empty."""
    return L.full_refresh_rows(clean_index(rows, ts), S.MARKET_INDEX, strict_flag="_bad_date")


# ------------------------------------------------------------------ A26 valuation

def clean_valuation(feed: DataFrame, ts=LOAD_TS) -> DataFrame:
    """A5/A6 -> A7 -> A10 -> A11 -> A8 lenient -> A12 -> A13 for every listed code."""
    numeric = list(VALUATION_SCALES)
    rows = C.lenient_numeric(C.venue_symbols(feed, "code"), numeric)
    rows = C.nan_to_null(C.round_to_scale(rows, VALUATION_SCALES), numeric)
    rows = C.drop_null_keys(C.lenient_date(rows, ["trade_date"]), ["trade_date"])
    return C.stamp(rows, ts)


def listed_codes(codes: DataFrame) -> DataFrame:
    """A5 + A6: the de-duplicated list of listed codes with their venue symbol."""
    return C.distinct_codes(C.venue_symbols(codes.select("code"), "code"), "code")


def ingest_valuation(feed: DataFrame, target: DataFrame | None = None, ts=LOAD_TS,
                     batch_size: int = VALUATION_BATCH, block_rows: int = 1 << 20):
    """Batches of ``batch_size`` rows per symbol in feed order; the first failing
    batch and everything after it is dropped for that symbol. -> (rows, failed)."""
    return L.append_prefix(clean_valuation(feed, ts), target, S.STOCK_VALUATION, unit="symbol", order="seq",
                           batch_size=batch_size, block_rows=block_rows, range_key="trade_date")


# ------------------------------------------------------------------ A25 daily bars

def clean_daily_bars(feed: DataFrame, ts=LOAD_TS, start: str = DAILY_START) -> DataFrame:
    """A4 -> A5 -> A8 strict -> A13; rows before ``start`` are not offered."""
    rows = C.rename_columns(C.venue_symbols(feed, "code"), V.DAILY_BAR_HEADERS)
    rows = C.strict_date(rows, ["trade_date"])
    rows = rows.filter((F.col("trade_date") >= F.lit(start).cast("date")) | F.col("_bad_date"))
    return C.stamp(rows, ts)


def ingest_daily_bars(feed: DataFrame, target: DataFrame | None = None, ts=LOAD_TS,
                      start: str = DAILY_START):
    """Rows from ``start`` on, strict dates, all-or-nothing per symbol."""
    return L.append_atomic(clean_daily_bars(feed, ts, start), target, S.STOCK_DAILY, unit="symbol",
                           bad_flag="_bad_date", range_key="trade_date")


# ------------------------------------------------------------------ A24 share capital

def clean_share_capital(feed: DataFrame, ts=LOAD_TS) -> DataFrame:
    """A4 -> A5 -> A7 -> A10 half-even (share counts to whole shares) -> A11 -> A8 strict."""
    numeric = list(CAP_SCALES)
    rows = C.venue_symbols(C.rename_columns(feed, V.SHARE_CAPITAL_HEADERS), "code")
    rows = C.nan_to_null(C.round_to_scale(C.lenient_numeric(rows, numeric), CAP_SCALES), numeric)
    return C.stamp(C.strict_date(rows, ["data_date"]), ts)


def ingest_share_capital(feed: DataFrame, target: DataFrame | None = None, ts=LOAD_TS):
    """All-or-nothing per symbol."""
    return L.append_atomic(clean_share_capital(feed, ts), target, S.STOCK_SHARE_CAP, unit="symbol",
                           bad_flag="_bad_date", range_key="data_date")


# ------------------------------------------------------------------ A23 dividends

def clean_dividends(feed: DataFrame, periods: list[str], ts=LOAD_TS) -> DataFrame:
    """A4 -> A7 -> A9 -> A11 -> A8 lenient -> A13 for the report periods requested.
    The periods are a short literal list (two per year), applied as a pushed-down
    ``IN`` filter rather than a join."""
    rows = feed.filter(F.col("report_date").isin(periods))
    rows = C.rename_columns(C.rename_columns(rows, V.DIVIDEND_HEADERS), {"code": "symbol"})
    rows = C.per_share(C.lenient_numeric(rows, DIVIDEND_RATIOS), DIVIDEND_RATIOS, 10)
    rows = C.nan_to_null(rows, DIVIDEND_RATIOS + DIVIDEND_NUMBERS)
    return C.stamp(C.lenient_date(rows, DIVIDEND_DATES), ts)


def ingest_dividends(feed: DataFrame, target: DataFrame | None = None, ts=LOAD_TS,
                     y0: int = REPORT_FIRST_YEAR, y1: int = REPORT_LAST_YEAR):
    """MERGE on (symbol, ex_dividend_date), periods in order, rows in feed order;
    bad rows skipped, the last good row per key wins. -> (table, rejected rows)."""
    rows = clean_dividends(feed, L.report_periods(y0, y1), ts)
    return L.upsert(target, rows, S.STOCK_DIVIDEND, seq=["report_date", "seq"])


def missing_dividend_periods(feed: DataFrame, y0: int = REPORT_FIRST_YEAR,
                             y1: int = REPORT_LAST_YEAR) -> DataFrame:
    """Requested report periods for which the feed has no rows (skipped loads)."""
    return L.missing_periods(feed, L.period_spine(feed.sparkSession, y0, y1))


# ------------------------------------------------------------------ A19 reports

def report_daily_bars(feed: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return L.load_report(clean_daily_bars(feed), ingest_daily_bars(feed, target)[0], "symbol")


def report_share_capital(feed: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return L.load_report(clean_share_capital(feed), ingest_share_capital(feed, target)[0], "symbol")


def report_valuation(feed: DataFrame, target: DataFrame | None = None, batch_size: int = VALUATION_BATCH) -> DataFrame:
    return L.load_report(clean_valuation(feed), ingest_valuation(feed, target, batch_size=batch_size)[0], "symbol")


def report_dividends(feed: DataFrame, y0: int = REPORT_FIRST_YEAR, y1: int = REPORT_LAST_YEAR) -> DataFrame:
    """Per report period; a merge row that meets the contract counts as inserted."""
    rows = clean_dividends(feed, L.report_periods(y0, y1))
    return L.load_report(rows, split_contract(rows, S.STOCK_DIVIDEND)[0], "report_date")


def report_index(rows: DataFrame) -> DataFrame:
    """Per market."""
    return L.load_report(rows, ingest_index_valuation(rows), "market")
