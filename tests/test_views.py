"""SQL users: statements over the registered views agree with the DataFrame functions."""

import os

import pytest

from suite_helpers import rows
from ledgerframe.plans import music as M
from ledgerframe.plans import portfolio as P
from ledgerframe.sources import bridge
from ledgerframe.sources.views import register_views

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def views(spark):
    return register_views(spark, SF, prefix="")


def test_tracks_listed_per_artist(spark, views):
    got = spark.sql("""
        SELECT who.artistid, who.name, SUM(listed.times) AS track_count
        FROM (SELECT trackid, COUNT(*) AS times FROM playlisttrack GROUP BY trackid) listed
        JOIN track USING (trackid) JOIN album disc USING (albumid) JOIN artist who USING (artistid)
        GROUP BY who.artistid, who.name""")
    want = M.artist_track_counts(bridge.store(spark, SF))
    assert rows(got, "artistid", "name", "track_count") == rows(want, "artistid", "name", "track_count")


def test_best_selling_genre_of_a_city(spark, views):
    got = spark.sql("""
        SELECT billingcountry, billingcity, max_by(genreid, (sold, -genreid)) AS genreid, MAX(sold) AS sold
        FROM (SELECT billingcountry, billingcity, genreid, SUM(quantity) AS sold
              FROM invoiceline JOIN invoice USING (invoiceid) JOIN track USING (trackid)
              WHERE billingcountry BETWEEN 'NATION_0' AND 'NATION_1'
              GROUP BY ALL)
        GROUP BY ALL""")
    countries = sorted({r["billingcountry"] for r in got.select("billingcountry").collect()})
    want = M.top_genre_per_city(bridge.store(spark, SF), countries)
    assert rows(got) == rows(want, "billingcountry", "billingcity", "genreid", "items_purchased")


def test_gain_of_each_ticker(spark, views):
    got = spark.sql("""
        WITH priced AS (
          SELECT p.ticker, p.closedate, p.closeprice, c.previous_business_date AS earlier
          FROM closeprices p JOIN calendar c ON c.closedate = p.closedate)
        SELECT held.ticker, SUM(held.quantity * (now.closeprice - prior.closeprice)) AS ticker_pl
        FROM positions held
          JOIN priced now ON now.ticker = held.ticker AND now.closedate = held.closedate
          JOIN closeprices prior ON prior.ticker = now.ticker AND prior.closedate = now.earlier
        GROUP BY held.ticker""")
    m = bridge.market(spark, SF)
    pos = P.net_positions(m.trades, m.calendar, m.summary)
    want = P.ticker_contributions(pos, m.calendar, m.closeprices)
    assert rows(got) == rows(want, "ticker", "ticker_pl")


def test_nav_accumulates_the_daily_results(spark, views):
    got = spark.sql("SELECT closedate, 100000 + SUM(pl) OVER (ORDER BY closedate) AS nav FROM pl")
    assert rows(got) == rows(spark.table("nav"))
