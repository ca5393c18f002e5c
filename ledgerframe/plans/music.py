"""Star-schema sales analytics over the music-store tables (FIXTURES.md section 3).

Fact-side tables (invoiceline, playlisttrack) are reduced before they meet the
dimensions: semi joins instead of DISTINCT over a join fan-out, and counts per track
before joining track attributes, so the shuffles carry one row per key rather than
one row per fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerframe.sources.bridge import Store


def top_rows(df: DataFrame, n: int, order: list[Column] | None = None,
             cols: list[str] | None = None) -> DataFrame:
    """K1: first / top ``n`` rows; an order is required for a deterministic result."""
    out = df.select(*cols) if cols else df
    return out.orderBy(*order).limit(n) if order else out.limit(n)


def top_per_group(df: DataFrame, partition: list[str], order: list[Column]) -> DataFrame:
    """``row_number() over (partition .. order ..) = 1``; Spark plans a WindowGroupLimit
    below the shuffle, so only each partition's local winners are exchanged."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


# ------------------------------------------------------------------ K2 filters

def filter_invoices(invoice: DataFrame, country: str | None = None, not_country: str | None = None,
                    after: str | None = None) -> DataFrame:
    """K2: invoices by country (=, <>) and strictly after a date (typed compare)."""
    c = F.lit(True)
    if country is not None:
        c = c & (F.col("billingcountry") == country)
    if not_country is not None:
        c = c & (F.col("billingcountry") != not_country)
    if after is not None:
        c = c & (F.col("invoicedate") > F.lit(after).cast("date"))
    return invoice.filter(c)


def filter_tracks(track: DataFrame, min_price=None, genres=None, name_like=None,
                  ms_between=None, exclude_album=None, equal_cols=None,
                  min_bytes=None) -> DataFrame:
    """K2: conjunction of >, IN, LIKE (case-insensitive, as the reference's engine),
    BETWEEN, <> and column = column; each predicate optional."""
    c = F.lit(True)
    if min_price is not None:
        c = c & (F.col("unitprice") > F.lit(min_price))
    if genres is not None:
        c = c & F.col("genreid").isin(list(genres))
    if name_like is not None:
        c = c & F.col("name").ilike(name_like)
    if ms_between is not None:
        c = c & F.col("milliseconds").between(*ms_between)
    if exclude_album is not None:
        c = c & (F.col("albumid") != exclude_album)
    if equal_cols is not None:
        c = c & (F.col(equal_cols[0]) == F.col(equal_cols[1]))
    if min_bytes is not None:
        c = c & (F.col("bytes") > min_bytes)
    return track.filter(c)


# ------------------------------------------------------------------ K3 .. K8

def playlist_tracks(s: Store) -> DataFrame:
    """K3: playlist joined to its track rows (ids once)."""
    return s.playlist.join(s.playlisttrack, "playlistid").select("playlistid", "trackid")


def playlist_track_detail(s: Store) -> DataFrame:
    """K3: playlist -> playlisttrack -> track, all track columns."""
    return playlist_tracks(s).join(s.track, "trackid").select(
        "playlistid", "trackid", "name", "albumid", "mediatypeid", "genreid", "composer",
        "milliseconds", "bytes", "unitprice")


def media_type_stats(track: DataFrame) -> DataFrame:
    """K4: bytes statistics per media type."""
    return track.groupBy("mediatypeid").agg(
        F.sum("bytes").alias("sumbytes"), F.avg("bytes").alias("avgbytes"),
        F.min("bytes").alias("minbytes"), F.max("bytes").alias("maxbytes"),
        (F.max("bytes") - F.min("bytes")).alias("byterange"))


def invoice_count_by_city(invoice: DataFrame, country: str) -> DataFrame:
    """K4: invoices per billing city within one country."""
    return (filter_invoices(invoice, country=country).groupBy("billingcity")
            .agg(F.count(F.lit(1)).alias("invoicecount")))


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """K5: DISTINCT on one or several columns."""
    return df.select(*cols).distinct()


def _listed_tracks(s: Store) -> DataFrame:
    """Ids of the tracks on any playlist, once each. A hot playlist's rows are the side
    of the semi join that Spark can split, and are reduced to tracks right after it."""
    return s.playlisttrack.join(s.playlist, "playlistid", "left_semi").select("trackid").distinct()


def _composer_tracks(s: Store, composer: str) -> DataFrame:
    """Tracks of one composer that sit on an album (the reference joins album)."""
    t = s.track.filter(F.col("composer") == composer).select("trackid", "albumid")
    return t.join(s.album.select("albumid", "title"), "albumid")


def playlists_with_composer(s: Store, composer: str) -> DataFrame:
    """K5: distinct playlists holding a track by ``composer`` (filter first, semi joins)."""
    t = _composer_tracks(s, composer)
    ids = s.playlisttrack.join(t, "trackid", "left_semi").select("playlistid").distinct()
    return s.playlist.join(ids, "playlistid", "left_semi").select("playlistid")


def albums_with_composer(s: Store, composer: str) -> DataFrame:
    """K5: distinct album titles of ``composer`` tracks that are on some playlist."""
    t = _composer_tracks(s, composer).join(_listed_tracks(s), "trackid", "left_semi")
    return t.select("title").distinct()


def artist_track_counts(s: Store) -> DataFrame:
    """K6: playlist-track rows per artist. Rows are counted per track first, so the
    joins to track / album / artist see one row per track, not per playlist entry."""
    per_track = (s.playlisttrack.join(s.playlist, "playlistid", "left_semi")
                 .groupBy("trackid").agg(F.count(F.lit(1)).alias("_n")))
    j = (per_track.join(s.track.select("trackid", "albumid"), "trackid")
         .join(s.album.select("albumid", "artistid"), "albumid")
         .join(s.artist, "artistid"))
    return j.groupBy("artistid", "name").agg(F.sum("_n").alias("track_count"))


def invoice_line_detail(s: Store) -> DataFrame:
    """K7: invoice -> invoiceline -> track, every column (clashing names prefixed)."""
    il = s.invoiceline.withColumnRenamed("unitprice", "line_unitprice")
    t = s.track.withColumnRenamed("name", "track_name").withColumnRenamed("unitprice", "track_unitprice")
    return s.invoice.join(il, "invoiceid").join(t, "trackid")


def track_album_genre(s: Store) -> DataFrame:
    """K7: track -> album -> genre, every column."""
    g = s.genre.withColumnRenamed("name", "genre_name")
    return s.track.join(s.album, "albumid").join(g, "genreid")


def track_album_genre_names(s: Store) -> DataFrame:
    """K7: track name, album title and genre name."""
    return track_album_genre(s).select(F.col("name").alias("track_name"),
                                       F.col("title").alias("album_name"),
                                       F.col("genre_name").alias("genre"))


def tracks_in_genre_like(s: Store, pattern: str, require_composer: bool = False) -> DataFrame:
    """K8: tracks whose genre name matches ``pattern`` (case-insensitive LIKE)."""
    g = s.genre.filter(F.col("name").ilike(pattern)).withColumnRenamed("name", "genre_name")
    t = s.track.filter(F.col("composer").isNotNull()) if require_composer else s.track
    return t.join(g, "genreid")


# ------------------------------------------------------------------ K9 .. K17

def _playlist_artist_album(s: Store) -> DataFrame:
    return (s.playlisttrack.join(s.track.select("trackid", "albumid", "unitprice"), "trackid")
            .join(s.album, "albumid")
            .join(s.artist.withColumnRenamed("name", "artist_name"), "artistid"))


def playlist_album_counts(s: Store, playlist_ids: list[int]) -> DataFrame:
    """K9: songs per (artist, album) on each given playlist; several ids give the
    UNION ALL of the per-playlist groupings (the playlist stays in the key)."""
    j = _playlist_artist_album(s).filter(F.col("playlistid").isin(list(playlist_ids)))
    g = j.groupBy("playlistid", "artist_name", "title").agg(F.count("trackid").alias("number_songs"))
    return g.select(F.col("artist_name").alias("name"), "title", "number_songs")


def album_costs(s: Store, playlist_id: int, artists: list[str]) -> DataFrame:
    """K9: sum of track unit prices per (artist, album) on a playlist, named artists only."""
    j = _playlist_artist_album(s).filter((F.col("playlistid") == playlist_id)
                                         & F.col("artist_name").isin(list(artists)))
    return j.groupBy("artist_name", "title").agg(F.sum("unitprice").alias("cost")).select(
        F.col("artist_name").alias("name"), "title", "cost")


def self_titled_albums(s: Store) -> DataFrame:
    """Albums whose title equals the artist's name."""
    return (s.album.join(s.artist, "artistid").filter(F.col("title") == F.col("name"))
            .select("albumid", "title", "artistid", "name"))


def top_city_by_avg_invoice(s: Store, country: str) -> DataFrame:
    """In one country, the billing city with the largest average invoice total,
    counting only invoices that have at least one line with a known track."""
    lines = s.invoiceline.join(s.track.select("trackid"), "trackid", "left_semi")
    inv = filter_invoices(s.invoice, country=country).join(lines, "invoiceid", "left_semi")
    g = inv.groupBy("billingcity").agg(F.avg("total").alias("avg_invoice"))
    return top_rows(g, 1, [F.col("avg_invoice").desc_nulls_last(), F.col("billingcity")])


def _city_genre_items(s: Store, countries: list[str]) -> DataFrame:
    inv = s.invoice.filter(F.col("billingcountry").isin(list(countries))).select(
        "invoiceid", "billingcity", "billingcountry")
    t = s.track.select("trackid", "genreid")
    g = s.genre.select("genreid", F.col("name").alias("genrename"))
    return (s.invoiceline.select("invoiceid", "trackid", "quantity").join(inv, "invoiceid")
            .join(t, "trackid").join(g, "genreid")
            .groupBy("billingcountry", "billingcity", "genreid", "genrename")
            .agg(F.sum("quantity").alias("items_purchased")))


def top_genre_per_city(s: Store, countries: list[str], by_country: bool = True) -> DataFrame:
    """Best-selling genre per city by quantity (tie: lowest genreid). With
    ``by_country=False`` cities are ranked by name alone, as the one-country statement."""
    part = ["billingcountry", "billingcity"] if by_country else ["billingcity"]
    return top_per_group(_city_genre_items(s, countries), part,
                         [F.col("items_purchased").desc_nulls_last(), F.col("genreid")])


def top_city_per_country(s: Store, countries: list[str]) -> DataFrame:
    """Per country the city with the largest average invoice (tie: city name);
    every invoice counts, with or without lines."""
    g = (s.invoice.filter(F.col("billingcountry").isin(list(countries)))
         .groupBy("billingcountry", "billingcity").agg(F.avg("total").alias("avg_invoice")))
    return top_per_group(g, ["billingcountry"], [F.col("avg_invoice").desc_nulls_last(), F.col("billingcity")])


def _tracks_on_playlists(s: Store) -> DataFrame:
    """Distinct tracks appearing on any playlist: semi joins, no fan-out."""
    return s.track.join(_listed_tracks(s), "trackid", "left_semi")


def genre_totals(s: Store) -> DataFrame:
    """Milliseconds and bytes per genre over distinct tracks on any playlist."""
    t = _tracks_on_playlists(s)
    return (t.join(s.genre.withColumnRenamed("name", "genre_name"), "genreid")
            .groupBy("genreid", "genre_name")
            .agg(F.sum("milliseconds").alias("milliseconds_total"), F.sum("bytes").alias("bytes_total")))


def _per_ms(bytes_col: str = "bytes_total", ms_col: str = "milliseconds_total") -> Column:
    return F.try_divide(F.col(bytes_col).cast("double"), F.nullif(F.col(ms_col), F.lit(0)).cast("double"))


def genre_bytes_per_ms(s: Store) -> DataFrame:
    """Bytes per millisecond per genre (NULL when no milliseconds)."""
    return genre_totals(s).withColumn("bytes_per_millisecond", _per_ms())


def genre_artist_bytes_per_ms(s: Store, exclude_genre: str) -> DataFrame:
    """As K13 per (genre, artist), one genre excluded."""
    t = _tracks_on_playlists(s).join(s.album.select("albumid", "artistid"), "albumid")
    g = s.genre.filter(F.col("name") != exclude_genre).withColumnRenamed("name", "genre_name")
    a = s.artist.withColumnRenamed("name", "artist_name")
    return (t.join(a, "artistid").join(g, "genreid")
            .groupBy("genreid", "genre_name", "artistid", "artist_name")
            .agg(F.sum("milliseconds").alias("milliseconds_total"), F.sum("bytes").alias("bytes_total"))
            .withColumn("bytes_per_millisecond", _per_ms()))


def album_genre_stats(s: Store) -> DataFrame:
    """Sum / min / max / avg / count of bytes per (album title, genre name)."""
    j = track_album_genre(s)
    return j.groupBy(F.col("title").alias("album_name"), F.col("genre_name").alias("genre")).agg(
        F.sum("bytes").alias("sum_bytes"), F.min("bytes").alias("min_bytes"),
        F.max("bytes").alias("max_bytes"), F.avg("bytes").alias("avg_bytes"),
        F.count("bytes").alias("count_bytes"))


def customer_reps(s: Store) -> DataFrame:
    """Each customer's country with its support rep."""
    j = s.employee.join(s.customer, s.customer.supportrepid == s.employee.employeeid)
    return j.select(F.col("country").alias("customer_country"), "supportrepid",
                    F.col("lastname").alias("employee_ln"), F.col("firstname").alias("employee_fn"))


def customers_by_country_rep(s: Store) -> DataFrame:
    """Customers per (country, rep first name)."""
    j = s.employee.join(s.customer, s.customer.supportrepid == s.employee.employeeid)
    return j.groupBy(F.col("country").alias("customer_country"), F.col("firstname").alias("employee_fn")).agg(
        F.count("customerid").alias("number_of_customers"))


def rep_efficiency(s: Store) -> DataFrame:
    """Distinct customers, invoice total and total per customer per (country, rep).
    Invoices are totalled per customer before the joins, so a row is a customer and the
    distinct count is a count."""
    per_customer = s.invoice.groupBy("customerid").agg(F.sum("total").alias("total"))
    c = s.customer.join(per_customer, "customerid")
    j = s.employee.join(c, c.supportrepid == s.employee.employeeid)
    g = j.groupBy(F.col("country").alias("customer_country"), F.col("firstname").alias("employee_fn")).agg(
        F.count("customerid").alias("number_of_unique_customers"),
        F.sum("total").alias("total_invoice_amount"))
    return g.withColumn("avg_invoice_per_customer",
                        F.try_divide(F.col("total_invoice_amount").cast("double"),
                                     F.col("number_of_unique_customers").cast("double")))


# ------------------------------------------------------------------ K19, K47 .. K49

def _line_albums(s: Store) -> DataFrame:
    return (s.invoiceline.select("invoiceid", "trackid")
            .join(s.track.select("trackid", "albumid", "genreid"), "trackid")
            .join(s.album.select("albumid", "title"), "albumid"))


def best_album_by_country(s: Store) -> DataFrame:
    """Most sold album title per billing country (equal titles merge; tie: title)."""
    j = _line_albums(s).join(s.invoice.select("invoiceid", "billingcountry"), "invoiceid")
    g = j.groupBy("billingcountry", F.col("title").alias("albumtitle")).agg(F.count(F.lit(1)).alias("salescount"))
    return top_per_group(g, ["billingcountry"], [F.col("salescount").desc(), F.col("albumtitle")])


def best_album_by_genre(s: Store) -> DataFrame:
    """Most sold album (by id and title) per genre name (tie: title)."""
    j = (_line_albums(s).join(s.invoice.select("invoiceid"), "invoiceid")
         .join(s.genre.select("genreid", F.col("name").alias("genre")), "genreid"))
    g = j.groupBy("genre", "albumid", F.col("title").alias("albumtitle")).agg(
        F.count(F.lit(1)).alias("salescount"))
    return top_per_group(g, ["genre"], [F.col("salescount").desc(), F.col("albumtitle")]).drop("albumid")


def revenue_per_invoice(s: Store) -> DataFrame:
    """Sum over lines of unit price / track bytes (0 bytes -> NULL term)."""
    j = (s.invoice.select("invoiceid").join(s.invoiceline.select("invoiceid", "trackid", "unitprice"), "invoiceid")
         .join(s.track.select("trackid", "bytes"), "trackid"))
    term = F.try_divide(F.col("unitprice").cast("double"), F.nullif(F.col("bytes").cast("double"), F.lit(0.0)))
    return j.groupBy("invoiceid").agg(F.sum(term).alias("revenue"))


def revenue_extremes(s: Store) -> DataFrame:
    """Largest and smallest revenue invoice, labelled (smallest puts NULL first; ties
    go to the lower id). Both ends come from one aggregate."""
    ends = revenue_per_invoice(s).agg(
        F.max(F.struct("revenue", (-F.col("invoiceid")).alias("back"))).alias("hi"),
        F.min(F.struct("revenue", "invoiceid")).alias("lo"))
    rows = F.array(
        F.struct(F.lit("Largest").alias("bucket"), (-F.col("hi.back")).alias("invoiceid"),
                 F.col("hi.revenue").alias("revenue")),
        F.struct(F.lit("Smallest").alias("bucket"), F.col("lo.invoiceid").alias("invoiceid"),
                 F.col("lo.revenue").alias("revenue")))
    return ends.filter(F.col("hi").isNotNull()).select(F.inline(rows))


def most_invoiced_song(s: Store) -> DataFrame:
    """Most frequent track *name* on invoice lines (equal names merge; tie: name).
    Lines are counted per track before the join to track names."""
    per_track = s.invoiceline.groupBy("trackid").agg(F.count(F.lit(1)).alias("_n"))
    g = per_track.join(s.track.select("trackid", "name"), "trackid").groupBy("name").agg(F.sum("_n").alias("n"))
    return top_rows(g, 1, [F.col("n").desc(), F.col("name")])


def largest_playlist(s: Store) -> DataFrame:
    """The playlist with the most tracks (tie: lowest id)."""
    g = s.playlisttrack.groupBy("playlistid").agg(F.count(F.lit(1)).alias("trackcount"))
    return top_rows(g, 1, [F.col("trackcount").desc(), F.col("playlistid")])
