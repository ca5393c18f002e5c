"""Registered music-store queries: (spark, sf_dir) -> DataFrame, one per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerframe.functions.output import comparable
from ledgerframe.plans import music as M
from ledgerframe.sources import bridge

# The reference's literals mapped onto the bridge data (FIXTURES.md 3).
COUNTRY = "NATION_0"                                   # 'France' / 'Germany'
COUNTRIES = ["NATION_0", "NATION_1", "NATION_2", "NATION_3"]  # Germany, USA, Canada, Argentina
COMPOSER = "Brand#1"                                   # 'Michael Jackson'
GENRE_LIKE = "%ar%"                                    # '%rap%'
EXCLUDED_GENRE = "PROMO"                               # 'Comedy'
ARTISTS = ["Supplier#000000000", "Supplier#000000005", "Supplier#000000007"]
PLAYLIST, PLAYLISTS, COST_PLAYLIST = 8, [8, 9], 1
AFTER_DATE = "1998-01-01"                              # '2010-01-01'
MIN_BYTES = 95000                                      # 1,000,000 (bytes here are 90,000-99,990)
# column = column: trackid = mediatypeid holds for no bridge track, so the predicate is
# exercised on genreid = mediatypeid
EQUAL_COLS = ("genreid", "mediatypeid")
TRACK_FILTER = dict(min_price=0.01, genres=[1, 2, 3, 4, 5], name_like="%a%",
                    ms_between=(100000, 500000), exclude_album=4)


def _q(build, decimals=None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(bridge.store(spark, sf_dir)), decimals)
    return run


QUERIES = {
    # K1
    "top_artists": _q(lambda s: M.top_rows(s.artist, 10, [F.col("artistid")])),
    "top_artists_by_id_desc": _q(lambda s: M.top_rows(s.artist, 10, [F.col("artistid").desc()])),
    "top_artist_names_desc": _q(lambda s: M.top_rows(s.artist, 10, [F.col("name").desc()], ["name"])),
    "first_artist_names": _q(lambda s: M.top_rows(s.artist, 10, [F.col("artistid")]).select("name")),
    "all_invoices": _q(lambda s: s.invoice),
    "all_tracks": _q(lambda s: s.track),
    "first_invoices": _q(lambda s: M.top_rows(s.invoice, 10, [F.col("invoiceid")])),
    "track_with_most_bytes": _q(lambda s: M.top_rows(s.track, 1, [F.col("bytes").desc(), F.col("trackid")])
                                .select("name")),
    "track_names_desc": _q(lambda s: s.track.select("name").orderBy(F.col("name").desc())),
    # K2
    "invoices_in_country": _q(lambda s: M.filter_invoices(s.invoice, country=COUNTRY)),
    "invoices_not_in_country": _q(lambda s: M.filter_invoices(s.invoice, not_country=COUNTRY)),
    "invoices_after_date": _q(lambda s: M.filter_invoices(s.invoice, after=AFTER_DATE)),
    "invoice_ids": _q(lambda s: s.invoice.select("invoiceid")),
    "tracks_over_bytes": _q(lambda s: M.filter_tracks(s.track, min_bytes=MIN_BYTES)),
    "tracks_filtered": _q(lambda s: M.filter_tracks(s.track, **TRACK_FILTER)),
    "tracks_cols_equal": _q(lambda s: M.filter_tracks(s.track, equal_cols=EQUAL_COLS)),
    # K3, K4
    "playlist_tracks": _q(M.playlist_tracks),
    "playlist_track_detail": _q(M.playlist_track_detail),
    "media_type_stats": _q(lambda s: M.media_type_stats(s.track), {"avgbytes": 6}),
    "invoice_count_by_city": _q(lambda s: M.invoice_count_by_city(s.invoice, COUNTRY)),
    # K5
    "distinct_playlist_ids": _q(lambda s: M.distinct_values(s.playlisttrack, "playlistid")),
    "distinct_cities_in_country": _q(lambda s: M.distinct_values(
        M.filter_invoices(s.invoice, country=COUNTRY), "billingcity")),
    "distinct_support_reps": _q(lambda s: M.distinct_values(s.customer, "supportrepid")),
    "distinct_employee_ids": _q(lambda s: M.distinct_values(s.employee, "employeeid")),
    "playlists_with_composer": _q(lambda s: M.playlists_with_composer(s, COMPOSER)),
    "albums_with_composer": _q(lambda s: M.albums_with_composer(s, COMPOSER)),
    # K6, K7, K8
    "artist_track_counts": _q(M.artist_track_counts),
    "invoice_line_detail": _q(M.invoice_line_detail),
    "track_album_genre": _q(M.track_album_genre),
    "track_album_genre_names": _q(M.track_album_genre_names),
    "tracks_in_genre_like": _q(lambda s: M.tracks_in_genre_like(s, GENRE_LIKE)),
    "tracks_in_genre_like_with_composer": _q(lambda s: M.tracks_in_genre_like(s, GENRE_LIKE, True)),
    # K9, K10
    "playlist_album_counts": _q(lambda s: M.playlist_album_counts(s, [PLAYLIST])),
    "playlist_album_counts_union": _q(lambda s: M.playlist_album_counts(s, PLAYLISTS)),
    "album_costs": _q(lambda s: M.album_costs(s, COST_PLAYLIST, ARTISTS)),
    "self_titled_albums": _q(M.self_titled_albums),
    # K11, K12
    "top_city_by_avg_invoice": _q(lambda s: M.top_city_by_avg_invoice(s, COUNTRY), {"avg_invoice": 6}),
    "top_genre_per_city": _q(lambda s: M.top_genre_per_city(s, [COUNTRY], by_country=False)),
    "top_genre_per_city_multi": _q(lambda s: M.top_genre_per_city(s, COUNTRIES)),
    "top_city_per_country": _q(lambda s: M.top_city_per_country(s, COUNTRIES), {"avg_invoice": 6}),
    # K13 .. K17
    "genre_totals": _q(M.genre_totals),
    "genre_bytes_per_ms": _q(M.genre_bytes_per_ms),
    "genre_artist_bytes_per_ms": _q(lambda s: M.genre_artist_bytes_per_ms(s, EXCLUDED_GENRE)),
    "album_genre_stats": _q(M.album_genre_stats, {"avg_bytes": 6}),
    "customer_reps": _q(M.customer_reps),
    "customers_by_country_rep": _q(M.customers_by_country_rep),
    "rep_efficiency": _q(M.rep_efficiency),
    # K19, K47 .. K49
    "best_album_by_country": _q(M.best_album_by_country),
    "best_album_by_genre": _q(M.best_album_by_genre),
    "revenue_extremes": _q(M.revenue_extremes, {"revenue": 9}),
    "most_invoiced_song": _q(M.most_invoiced_song),
    "largest_playlist": _q(M.largest_playlist),
}
