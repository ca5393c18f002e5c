"""Sector panel quirks (Q21, Q24) and music-store semantics."""

import datetime as dt
from decimal import Decimal

from suite_helpers import rows
from ledgerframe.plans import music as M
from ledgerframe.plans import sectors as Z
from ledgerframe.sources.bridge import Store

D = dt.date


def _changes(spark):
    return spark.createDataFrame([
        ("s1", D(2024, 1, 2), "X"), ("s1", D(2024, 1, 4), None), ("s1", D(2024, 1, 5), "Y"),
        ("s2", D(2024, 1, 1), None)], "symbol string, start_date date, industry_code string")


def test_panel_fill_unk_and_null_codes(spark):
    p = {(r["date"].day, r["symbol"]): r["industry_code"]
         for r in Z.sector_code_panel(_changes(spark), end="2024-01-06").collect()}
    assert [p[(d, "s1")] for d in range(1, 7)] == ["UNK", "X", "X", "X", "Y", "Y"]   # NULL keeps X
    assert all(p[(d, "s2")] == "UNK" for d in range(1, 7))
    assert len(p) == 12


def test_panel_later_start_forgets_earlier_codes(spark):
    p = {(r["date"].day, r["symbol"]): r["industry_code"]
         for r in Z.sector_code_panel(_changes(spark), start="2024-01-03", end="2024-01-05").collect()}
    assert [p[(d, "s1")] for d in (3, 4, 5)] == ["UNK", "UNK", "Y"]


def test_sector_mapping_unk(spark):
    panel = spark.createDataFrame([(D(2024, 1, 1), "s1", "X"), (D(2024, 1, 1), "s2", "UNK"),
                                   (D(2024, 1, 1), "s3", "Q")], "date date, symbol string, industry_code string")
    mapping = spark.createDataFrame([("X", None, None, "xx")],
                                    "industry_code string, level1 string, level2 string, level3 string")
    got = rows(Z.sector_and_industry(panel, mapping).select("symbol", "sector", "industry"))
    assert got == [("s1", "UNK", "xx"), ("s2", "UNK", "UNK"), ("s3", "UNK", "UNK")]


def _store(spark):
    artist = spark.createDataFrame([(1, "Art1"), (2, "Art2")], "artistid long, name string")
    album = spark.createDataFrame([(10, "Art1", 1), (11, "T2", 2)], "albumid long, title string, artistid long")
    genre = spark.createDataFrame([(1, "Rock")], "genreid int, name string")
    track = spark.createDataFrame([
        (100, "a", 10, 1, 1, "c", 1000, 0, Decimal("1.00")),
        (101, "b", 11, 1, 1, None, 2000, 500, Decimal("2.00"))],
        "trackid long, name string, albumid long, mediatypeid int, genreid int, composer string, "
        "milliseconds long, bytes long, unitprice decimal(12,2)")
    playlist = spark.createDataFrame([(8,), (9,)], "playlistid long")
    pt = spark.createDataFrame([(8, 100), (8, 101), (9, 100)], "playlistid long, trackid long")
    invoice = spark.createDataFrame([(1, 1, D(2024, 1, 1), "c", "N", Decimal("5.00")),
                                     (2, 1, D(2024, 1, 1), "c", "N", Decimal("7.00"))],
                                    "invoiceid long, customerid long, invoicedate date, billingcity string, "
                                    "billingcountry string, total decimal(14,2)")
    line = spark.createDataFrame([(1, 100, Decimal("1.00"), 1), (1, 101, Decimal("2.00"), 1),
                                  (2, 101, Decimal("4.00"), 1)],
                                 "invoiceid long, trackid long, unitprice decimal(12,2), quantity long")
    cust = spark.createDataFrame([(1, "N", 1)], "customerid long, country string, supportrepid long")
    emp = spark.createDataFrame([(1, "L", "F")], "employeeid long, lastname string, firstname string")
    return Store(artist, album, genre, track, playlist, pt, invoice, line, cust, emp)


def test_union_of_playlists_keeps_per_playlist_groups(spark):
    got = rows(M.playlist_album_counts(_store(spark), [8, 9]))
    assert got == [("Art1", "Art1", 1), ("Art1", "Art1", 1), ("Art2", "T2", 1)]


def test_genre_totals_count_each_track_once(spark):
    got = rows(M.genre_bytes_per_ms(_store(spark)))
    assert got == [(1, "Rock", 3000, 500, 500 / 3000)]


def test_revenue_extremes_null_first(spark):
    got = {r["bucket"]: (r["invoiceid"], r["revenue"]) for r in M.revenue_extremes(_store(spark)).collect()}
    assert got["Largest"] == (2, 4.0 / 500)
    assert got["Smallest"] == (1, 2.0 / 500)   # the 0-byte line is a NULL term, the sum is not NULL


def test_self_titled_and_top_playlist(spark):
    s = _store(spark)
    assert rows(M.self_titled_albums(s).select("albumid")) == [(10,)]
    assert M.largest_playlist(s).first()["playlistid"] == 8


def test_conflicting_changes_raise_and_are_listed(spark):
    import pytest
    changes = _changes(spark).union(spark.createDataFrame([("s1", D(2024, 1, 5), "Z")], _changes(spark).schema))
    assert rows(Z.change_conflicts(changes)) == [("s1", D(2024, 1, 5), 2, "Y", "Z")]
    with pytest.raises(Exception, match="not unique: symbol s1 on 2024-01-05"):
        Z.sector_code_panel(changes, end="2024-01-06").collect()


def test_rep_efficiency_counts_customers_once(spark):
    got = rows(M.rep_efficiency(_store(spark)))
    assert got == [("N", "F", 1, Decimal("12.00"), 12.0)]
