"""Register the reference's tables as Spark SQL temp views.

Users of the reference run SQL statements against tables named trades, closeprices,
calendar, positions, pl, nav, artist, album, track, ... With the views registered,
the same statements run through ``spark.sql`` (Catalyst plans them; nothing here
parses SQL). SQLite-only syntax (``strftime``, ``date(d, '-1 day')``, quoted column
names like ``t.'Action'``) needs its Spark spelling (``date_format``, ``date_sub``,
backticks).

The views are lazy plans over the given data directory: positions / pl / nav are
defined by the set-based operators of ``plans.portfolio`` (no theta joins), so a
statement selecting from ``positions`` gets the scalable plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from ledgerframe.plans import portfolio as P
from ledgerframe.plans import sectors as Z
from ledgerframe.sources import bridge

MARKET_VIEWS = ("trades", "closeprices", "calendar", "positions", "pl", "nav", "dow_historical_data")
STORE_VIEWS = ("artist", "album", "genre", "track", "playlist", "playlisttrack", "invoice",
               "invoiceline", "customer", "employee")
SECTOR_VIEWS = ("stock_sector", "sector_mapping")


def register_views(spark: SparkSession, sf_dir: str, prefix: str = "") -> list[str]:
    """Create or replace the temp views; returns their names."""
    m = bridge.market(spark, sf_dir)
    trades, summary, closeprices, calendar = m.trades, m.summary, m.closeprices, m.calendar
    positions = P.net_positions(trades, calendar, summary)
    pl = P.daily_pl(positions, trades, calendar, closeprices, summary)
    frames = {
        "trades": trades, "closeprices": closeprices, "calendar": calendar,
        "positions": positions, "pl": pl, "nav": P.nav(pl),
        "dow_historical_data": closeprices.select(F.col("closedate").alias("date"), "ticker",
                                                  F.col("closeprice").alias("close")),
        "stock_sector": Z.load_sector_changes(bridge.stock_sector(spark, sf_dir)),
        "sector_mapping": bridge.sector_mapping(spark, sf_dir),
    }
    store = bridge.store(spark, sf_dir)
    frames.update({name: getattr(store, name) for name in STORE_VIEWS})
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in frames]
