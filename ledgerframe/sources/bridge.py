"""Bridge from the driver's TPC-H-like tables to the reference's domain tables.

The reference ships no data, so its input tables (trades, closeprices, calendar, the
music-store star schema, the sector table and raw vendor feeds) are derived from the
driver's tables by the fixed recipes of FIXTURES.md. Every derivation is a plain
DataFrame plan, so the work grows with the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerframe.operators.tradeday import daily_trade_summary
from ledgerframe.sources.tables import scan_table


# --------------------------------------------------------------------------- market

# Month and day on which the bridge has prices but no trades.
HOLIDAYS = ("01-01", "05-01", "12-25")

def _price() -> Column:
    """The line's price with four places, so that sub-cent prices occur."""
    cents = F.col("l_extendedprice").cast("decimal(12,2)").cast("decimal(12,4)")
    return (cents + (F.col("l_orderkey") % 97).cast("decimal(4,0)") * F.lit(Decimal("0.0001"))).cast("decimal(12,4)")


def is_trading_day(day: str) -> Column:
    """The book doesn't trade on HOLIDAYS; the market still quotes."""
    return ~F.date_format(day, "MM-dd").isin(*HOLIDAYS)


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem with a part, in the shape of a trade."""
    li = scan_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_quantity", "l_extendedprice", "l_shipdate")
    part = scan_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    flag = F.col("l_returnflag")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("orderid"),
        F.col("l_shipdate").cast("date").alias("tradedate"),
        F.col("p_type").alias("ticker"),
        F.when(flag == "R", "Sell").when(flag == "A", "sell").otherwise("Buy").alias("action"),
        F.col("l_quantity").cast("bigint").alias("shares"),
        _price().alias("tradeprice"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orderid, tradedate, ticker, action, shares, tradeprice: the quotes of trading days."""
    return quotes(spark, sf_dir).filter(is_trading_day("tradedate"))


def closeprices_from_summary(summary: DataFrame) -> DataFrame:
    """closedate, ticker, closeprice, volume: weekday ticker-days, highest quoted price."""
    return summary.filter(F.weekday("tradedate") < 5).select(
        F.col("tradedate").alias("closedate"), "ticker",
        F.col("max_price").alias("closeprice"),
        F.col("shares").cast("bigint").alias("volume"),
    )


def calendar_between(lo: DataFrame) -> DataFrame:
    """Dense calendar from a one-row frame (lo, hi): every day, weekends included,
    with the previous business day (Mon -> Fri, Sun -> Fri, else the day before).
    The day list is generated, not joined, and is bounded by the date range."""
    days = lo.select(F.explode(F.sequence("lo", "hi")).alias("closedate"))
    wd = F.weekday("closedate")
    back = F.when(wd == 0, 3).when(wd == 6, 2).otherwise(1)
    return days.select("closedate", F.date_sub("closedate", back).alias("previous_business_date"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the first to the last shipping date: a scan of one column."""
    li = scan_table(spark, sf_dir, "lineitem").select("l_shipdate")
    bounds = li.agg(F.min("l_shipdate").cast("date").alias("lo"),
                    F.max("l_shipdate").cast("date").alias("hi"))
    return calendar_between(bounds)


@dataclass
class Market:
    """Input tables of the portfolio analytics, sharing one ticker-day summary."""
    trades: DataFrame
    summary: DataFrame
    closeprices: DataFrame
    calendar: DataFrame


def market(spark: SparkSession, sf_dir: str) -> Market:
    """Lazy input tables: quotes are folded once, trades and prices both come from that."""
    quoted = daily_trade_summary(quotes(spark, sf_dir))
    return Market(trades(spark, sf_dir), quoted.filter(is_trading_day("tradedate")),
                  closeprices_from_summary(quoted), calendar(spark, sf_dir))


# ---------------------------------------------------------------------- music store

def _genre_id(col: str = "p_type"):
    c = F.col(col)
    return (F.when(c == "ECONOMY", 1).when(c == "LARGE", 2).when(c == "MEDIUM", 3)
            .when(c == "PROMO", 4).when(c == "SMALL", 5).otherwise(6))


@dataclass
class Store:
    artist: DataFrame
    album: DataFrame
    genre: DataFrame
    track: DataFrame
    playlist: DataFrame
    playlisttrack: DataFrame
    invoice: DataFrame
    invoiceline: DataFrame
    customer: DataFrame
    employee: DataFrame


class LazyStore:
    """The music-store tables of one data directory, each built on first use (a query
    touching three tables reads and analyses only those)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _t(self, name: str) -> DataFrame:
        return scan_table(self.spark, self.sf_dir, name)

    @cached_property
    def _n_sup(self):
        return self._t("supplier").select(F.count(F.lit(1))).scalar()  # scalar subquery

    @cached_property
    def _supplier(self) -> DataFrame:
        return self._t("supplier").select("s_suppkey", "s_name")

    @cached_property
    def _cust_nation(self) -> DataFrame:
        cust = self._t("customer")
        nation = self._t("nation").select("n_nationkey", "n_name")
        return cust.join(nation, cust.c_nationkey == nation.n_nationkey)

    @cached_property
    def artist(self) -> DataFrame:
        return self._supplier.select(F.col("s_suppkey").alias("artistid"), F.col("s_name").alias("name"))

    @cached_property
    def album(self) -> DataFrame:
        k = F.col("k")
        albumid = F.col("s_suppkey") * 2 + k
        return (self._supplier.select("s_suppkey", "s_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
                .select(albumid.alias("albumid"),
                        F.when((k == 0) & (F.col("s_suppkey") % 5 == 0), F.col("s_name"))
                        .otherwise(F.concat(F.lit("Album#"), albumid.cast("string"))).alias("title"),
                        F.col("s_suppkey").alias("artistid")))

    @cached_property
    def genre(self) -> DataFrame:
        return self._t("part").select(_genre_id().alias("genreid"), F.col("p_type").alias("name")).distinct()

    @cached_property
    def track(self) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(12,2)")
        return self._t("part").select(
            F.col("p_partkey").alias("trackid"),
            F.col("p_name").alias("name"),
            (F.col("p_partkey") % (2 * self._n_sup)).alias("albumid"),
            (F.col("p_size") % 5).alias("mediatypeid"),
            _genre_id().alias("genreid"),
            F.when(F.col("p_size") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("composer"),
            (F.col("p_size") * 10000).cast("bigint").alias("milliseconds"),
            F.when(F.col("p_size") % 10 == 0, F.lit(0).cast("bigint"))
            .otherwise((price * 100).cast("bigint")).alias("bytes"),
            price.alias("unitprice"),
        )

    @cached_property
    def playlist(self) -> DataFrame:
        # a plain table: a join of playlisttrack with its own DISTINCT could not be split
        # at a hot playlist
        return self._t("supplier").select(F.col("s_suppkey").alias("playlistid"))

    @cached_property
    def playlisttrack(self) -> DataFrame:
        return self._t("lineitem").select(F.col("l_suppkey").alias("playlistid"),
                                          F.col("l_partkey").alias("trackid")).distinct()

    @cached_property
    def invoice(self) -> DataFrame:
        orders = self._t("orders")
        cn = self._cust_nation
        return orders.join(cn, orders.o_custkey == cn.c_custkey).select(
            F.col("o_orderkey").alias("invoiceid"),
            F.col("o_custkey").alias("customerid"),
            F.col("o_orderdate").cast("date").alias("invoicedate"),
            F.col("c_mktsegment").alias("billingcity"),
            F.col("n_name").alias("billingcountry"),
            F.col("o_totalprice").cast("decimal(14,2)").alias("total"),
        )

    @cached_property
    def invoiceline(self) -> DataFrame:
        return self._t("lineitem").select(
            F.col("l_orderkey").alias("invoiceid"),
            F.col("l_partkey").alias("trackid"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("unitprice"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
        )

    @cached_property
    def customer(self) -> DataFrame:
        return self._cust_nation.select(
            F.col("c_custkey").alias("customerid"),
            F.col("n_name").alias("country"),
            (F.col("c_custkey") % self._n_sup).alias("supportrepid"),
        )

    @cached_property
    def employee(self) -> DataFrame:
        return self._supplier.select(
            F.col("s_suppkey").alias("employeeid"),
            F.col("s_name").alias("lastname"),
            F.concat(F.lit("Rep"), (F.col("s_suppkey") % 7).cast("string")).alias("firstname"),
        )


def store(spark: SparkSession, sf_dir: str) -> LazyStore:
    """Music-store tables (FIXTURES.md section 3), built on first use."""
    return LazyStore(spark, sf_dir)


# ------------------------------------------------------------------ sectors and feeds

def stock_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, start_date, industry_code (nullable): one change row per (symbol, day)."""
    o = scan_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    sym = F.col("o_custkey") % 50
    g = o.groupBy(sym.alias("k"), F.col("o_orderdate").cast("date").alias("start_date")).agg(
        F.min("o_orderpriority").alias("code"))
    return g.select(
        F.col("k").cast("string").alias("symbol"),
        "start_date",
        F.when((F.col("code") == "3-MEDIUM") & (F.col("k") < 10), F.lit(None).cast("string"))
        .otherwise(F.col("code")).alias("industry_code"),
    )


def raw_sector_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change table before it is made unique: symbol, start_date, industry_code."""
    o = scan_table(spark, sf_dir, "orders")
    return o.select((F.col("o_custkey") % 50).cast("string").alias("symbol"),
                    F.col("o_orderdate").cast("date").alias("start_date"),
                    F.col("o_orderpriority").alias("industry_code")).distinct()


def sector_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """industry_code (unique), level1 (nullable), level2, level3."""
    o = scan_table(spark, sf_dir, "orders").select("o_orderpriority")
    p = F.col("o_orderpriority")
    return o.filter(p != "5-LOW").select(
        p.alias("industry_code"),
        F.when(p == "4-NOT SPECIFIED", F.lit(None).cast("string")).otherwise(F.substring(p, 1, 1)).alias("level1"),
        F.lit(None).cast("string").alias("level2"),
        F.expr("substr(o_orderpriority, 3)").alias("level3"),
    ).distinct()
