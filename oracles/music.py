"""Oracles for the music-store queries (DuckDB dialect).

song carries its genre's name (the bridge derives both from one column), membership is
tested with EXISTS, and winners are picked with QUALIFY.
"""

from __future__ import annotations

from oracles.common import with_ctes

_STYLE = "coalesce(nullif(list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL'], p_type), 0), 6)"

CTES = {
    "perf": "select s_suppkey as pf, s_name as pname from supplier",
    "disc": """select 2 * s_suppkey + half as dc, s_suppkey as pf,
        if(half = 0 and s_suppkey % 5 = 0, s_name, 'Album#' || (2 * s_suppkey + half)) as dname
      from supplier, (values (0), (1)) as halves(half)""",
    "song": f"""select p_partkey as sg, p_name as sname, p_partkey % (2 * (select count(*) from supplier)) as dc,
        p_size % 5 as media, {_STYLE} as st, p_type as stname, if(p_size % 7 = 0, null, p_brand) as author,
        cast(10000 * p_size as bigint) as ms,
        cast(if(p_size % 10 = 0, 0, 100 * cast(p_retailprice as decimal(12,2))) as bigint) as bytes,
        cast(p_retailprice as decimal(12,2)) as price
      from part""",
    "lists": "select s_suppkey as ls from supplier",
    "entry": "select l_suppkey as ls, l_partkey as sg from lineitem group by all",
    "client": """select c_custkey as cl, n_name as land, c_custkey % (select count(*) from supplier) as ag,
        c_mktsegment as town
      from customer, nation where n_nationkey = c_nationkey""",
    "agent": "select s_suppkey as ag, s_name as family, 'Rep' || (s_suppkey % 7) as given from supplier",
    "bill": """select o_orderkey as bl, o_custkey as cl, cast(o_orderdate as date) as day, town, land,
        cast(o_totalprice as decimal(14,2)) as total
      from orders, client where cl = o_custkey""",
    "item": """select l_orderkey as bl, l_partkey as sg, cast(l_quantity as bigint) as n,
        cast(l_extendedprice as decimal(12,2)) as price
      from lineitem""",
    "listed": """select * from song where exists (
        from entry where entry.sg = song.sg and entry.ls in (select ls from lists))""",
}
ALL = list(CTES)


def m(body: str, **extra: str) -> str:
    return with_ctes(CTES, ALL, body, **extra)


def money(column: str, name: str) -> str:
    return f"cast({column} as decimal(38,2)) as {name}"


_SONG = (f"song.sg as trackid, sname as name, song.dc as albumid, media as mediatypeid, st as genreid, "
         f"author as composer, ms as milliseconds, bytes, {money('song.price', 'unitprice')}")
_BILL = (f"bl as invoiceid, cl as customerid, day as invoicedate, town as billingcity, land as billingcountry, "
         f"{money('total', 'total')}")
_FOUR = "('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3')"
_PER_MS = "cast(sum(bytes) as double) / nullif(cast(sum(ms) as double), 0) as bytes_per_millisecond"
_SUMS = "cast(sum(ms) as bigint) as milliseconds_total, cast(sum(bytes) as bigint) as bytes_total"
_SOLD = "from item join song using (sg) join bill using (bl)"


def _on_lists(numbers: str) -> str:
    return f"""select pname as name, dname as title, n as number_songs
      from (select ls, dc, count(*) as n from entry join song using (sg) where ls in ({numbers}) group by all)
        join disc using (dc) join perf using (pf)"""


MUSIC_SQL = {
    "top_artists": m("select pf as artistid, pname as name from perf qualify row_number() over (order by pf) <= 10"),
    "top_artists_by_id_desc": m("""select pf as artistid, pname as name from perf
      qualify row_number() over (order by pf desc) <= 10"""),
    "top_artist_names_desc": m("select unnest(max(pname, 10)) as name from perf"),
    "first_artist_names": m("select unnest(min_by(pname, pf, 10)) as name from perf"),
    "all_invoices": m(f"select {_BILL} from bill"),
    "all_tracks": m(f"select {_SONG} from song"),
    "first_invoices": m(f"select {_BILL} from bill qualify row_number() over (order by bl) <= 10"),
    "track_with_most_bytes": m("select arg_max(sname, (bytes, -sg)) as name from song"),
    "track_names_desc": m("select sname as name from song"),
    "invoices_in_country": m(f"select {_BILL} from bill where land = 'NATION_0'"),
    "invoices_not_in_country": m(f"select {_BILL} from bill where not land = 'NATION_0'"),
    "invoices_after_date": m(f"select {_BILL} from bill where day > date '1998-01-01'"),
    "invoice_ids": m("select bl as invoiceid from bill"),
    "tracks_over_bytes": m(f"select {_SONG} from song where bytes > 95000"),
    "tracks_filtered": m(f"""select {_SONG} from song
      where price > 0.01 and st <= 5 and contains(lower(sname), 'a') and ms >= 100000 and ms <= 500000
        and not dc = 4"""),
    "tracks_cols_equal": m(f"select {_SONG} from song where media = st"),
    "playlist_tracks": m("select ls as playlistid, sg as trackid from entry where ls in (select ls from lists)"),
    "playlist_track_detail": m(f"select ls as playlistid, {_SONG} from entry join song using (sg) semi join lists using (ls)"),
    "media_type_stats": m("""select media as mediatypeid, cast(sum(bytes) as bigint) as sumbytes,
        round(avg(bytes), 6) as avgbytes, min(bytes) as minbytes, max(bytes) as maxbytes,
        max(bytes) - min(bytes) as byterange
      from song group by media"""),
    "invoice_count_by_city": m("""select town as billingcity, count(*) as invoicecount from bill
      where land = 'NATION_0' group by all"""),
    "distinct_playlist_ids": m("select ls as playlistid from entry group by ls"),
    "distinct_cities_in_country": m("select town as billingcity from bill where land = 'NATION_0' group by all"),
    "distinct_support_reps": m("select ag as supportrepid from client group by ag"),
    "distinct_employee_ids": m("select ag as employeeid from agent group by ag"),
    "playlists_with_composer": m("""select ls as playlistid from lists where ls in (
        select entry.ls from entry semi join (from song semi join disc using (dc) where author = 'Brand#1') using (sg))"""),
    "albums_with_composer": m("""select dname as title from disc semi join (from listed where author = 'Brand#1') using (dc)
      group by all"""),
    "artist_track_counts": m("""select pf as artistid, pname as name, cast(sum(times) as bigint) as track_count
      from (select sg, count(*) as times from entry semi join lists using (ls) group by sg)
        join song using (sg) join disc using (dc) join perf using (pf) group by all"""),
    "invoice_line_detail": m(f"""select bl as invoiceid, cl as customerid, day as invoicedate, town as billingcity,
        land as billingcountry, {money('total', 'total')}, sg as trackid, {money('item.price', 'line_unitprice')},
        n as quantity, sname as track_name, dc as albumid, media as mediatypeid, st as genreid, author as composer,
        ms as milliseconds, bytes, {money('song.price', 'track_unitprice')}
      {_SOLD}"""),
    "track_album_genre": m(f"""select {_SONG}, dname as title, pf as artistid, stname as genre_name
      from song join disc using (dc)"""),
    "track_album_genre_names": m("""select sname as track_name, dname as album_name, stname as genre
      from song join disc using (dc)"""),
    "tracks_in_genre_like": m(f"select {_SONG}, stname as genre_name from song where contains(lower(stname), 'ar')"),
    "tracks_in_genre_like_with_composer": m(f"""select {_SONG}, stname as genre_name from song
      where contains(lower(stname), 'ar') and author is not null"""),
    "playlist_album_counts": m(_on_lists("8")),
    "playlist_album_counts_union": m(_on_lists("8, 9")),
    "album_costs": m(f"""select pname as name, dname as title, {money('sum(song.price)', 'cost')}
      from song join disc using (dc) join perf using (pf)
      where song.sg in (select sg from entry where ls = 1) and pf in (0, 5, 7)
        and pname = 'Supplier#' || lpad(cast(pf as varchar), 9, '0') group by all"""),
    "self_titled_albums": m("""select dc as albumid, dname as title, pf as artistid, dname as name
      from disc where dname = (select pname from perf where perf.pf = disc.pf)"""),
    "top_city_by_avg_invoice": m("""select town as billingcity, round(avg(total), 6) as avg_invoice
      from bill where land = 'NATION_0' and bl in (select bl from item semi join song using (sg))
      group by town order by avg(total) desc, town limit 1"""),
    "top_genre_per_city": m(f"""select town as billingcity, land as billingcountry, st as genreid, stname as genrename,
        cast(sum(n) as bigint) as items_purchased
      {_SOLD} where land = 'NATION_0' group by town, land, st, stname
      qualify rank() over (partition by town order by sum(n) desc, st) = 1"""),
    "top_genre_per_city_multi": m(f"""select land as billingcountry, town as billingcity, st as genreid,
        stname as genrename, cast(sum(n) as bigint) as items_purchased
      {_SOLD} where land in {_FOUR} group by land, town, st, stname
      qualify rank() over (partition by land, town order by sum(n) desc, st) = 1"""),
    "top_city_per_country": m(f"""select land as billingcountry, town as billingcity, round(avg(total), 6) as avg_invoice
      from bill where land in {_FOUR} group by land, town
      qualify rank() over (partition by land order by avg(total) desc, town) = 1"""),
    "genre_totals": m(f"select st as genreid, stname as genre_name, {_SUMS} from listed group by all"),
    "genre_bytes_per_ms": m(f"select st as genreid, stname as genre_name, {_SUMS}, {_PER_MS} from listed group by all"),
    "genre_artist_bytes_per_ms": m(f"""select st as genreid, stname as genre_name, pf as artistid, pname as artist_name,
        {_SUMS}, {_PER_MS}
      from listed join disc using (dc) join perf using (pf) where stname <> 'PROMO' group by all"""),
    "album_genre_stats": m("""select dname as album_name, stname as genre, cast(sum(bytes) as bigint) as sum_bytes,
        min(bytes) as min_bytes, max(bytes) as max_bytes, round(avg(bytes), 6) as avg_bytes, count(bytes) as count_bytes
      from song join disc using (dc) group by all"""),
    "customer_reps": m("""select land as customer_country, ag as supportrepid, family as employee_ln, given as employee_fn
      from client join agent using (ag)"""),
    "customers_by_country_rep": m("""select land as customer_country, given as employee_fn,
        count(*) as number_of_customers
      from client join agent using (ag) group by all"""),
    "rep_efficiency": m(f"""select land as customer_country, given as employee_fn,
        count(*) as number_of_unique_customers, {money('sum(spent)', 'total_invoice_amount')},
        cast(sum(spent) as double) / count(*) as avg_invoice_per_customer
      from (select cl, sum(total) as spent from bill group by cl) join client using (cl) join agent using (ag)
      group by all"""),
    "best_album_by_country": m(f"""select land as billingcountry, dname as albumtitle, count(*) as salescount
      {_SOLD} join disc using (dc) group by land, dname
      qualify rank() over (partition by land order by count(*) desc, dname) = 1"""),
    "best_album_by_genre": m(f"""select genre, albumtitle, salescount from (
        select stname as genre, dc, dname as albumtitle, count(*) as salescount
        {_SOLD} join disc using (dc) group by all)
      qualify row_number() over (partition by genre order by salescount desc, albumtitle) = 1"""),
    "revenue_extremes": m("""select if(high = 1, 'Largest', 'Smallest') as bucket, bl as invoiceid, round(gain, 9) as revenue
      from (select *, row_number() over (order by gain desc nulls last, bl) as high,
              row_number() over (order by gain nulls first, bl) as low
            from (select bl, sum(cast(item.price as double) / nullif(cast(bytes as double), 0)) as gain
                  from item join song using (sg) semi join bill using (bl) group by bl))
      where high = 1 or low = 1"""),
    "most_invoiced_song": m("""select sname as name, count(*) as n from item join song using (sg) group by sname
      qualify row_number() over (order by count(*) desc, sname) = 1"""),
    "largest_playlist": m("""select ls as playlistid, count(*) as trackcount from entry group by ls
      qualify row_number() over (order by count(*) desc, ls) = 1"""),
}
