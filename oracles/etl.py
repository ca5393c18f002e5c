"""Oracles for the load jobs (A-rows) and the sector panel (K44, K45), DuckDB dialect.

The target DDL below restates FIXTURES.md section 1 (types, NOT NULL, lengths); the
violation text per row is generated from it in the library's order (per column:
invalid value, NULL in NOT NULL column, over-long text).
"""

from __future__ import annotations

import re

from oracles.common import with_ctes

TS = "TIMESTAMP '2025-01-01 00:00:00'"

# The target tables' columns (column, type, not_null, varchar length).
VALUATION = [("symbol", "varchar", True, 10), ("trade_date", "date", True, None)] + [
    (c, "decimal(18,6)", False, None) for c in ("pe", "pe_ttm", "pb", "ps", "ps_ttm", "dv_ratio", "dv_ttm")
] + [("total_mv", "decimal(20,2)", False, None), ("update_time", "timestamp", True, None)]
DAILY = [("symbol", "varchar", True, 10), ("trade_date", "date", True, None)] + [
    (c, "decimal(9,4)", False, None) for c in ("open", "high", "low", "close")
] + [("volume", "decimal(15,2)", False, None), ("amount", "decimal(20,2)", False, None),
     ("turnover", "decimal(9,6)", False, None), ("update_time", "timestamp", True, None)]
CAP = [("symbol", "varchar", True, 10), ("data_date", "date", True, None),
       ("close", "decimal(15,4)", False, None), ("change_pct", "decimal(15,6)", False, None),
       ("total_mv", "decimal(20,2)", False, None), ("circulating_mv", "decimal(20,2)", False, None),
       ("total_share", "decimal(38,0)", False, None), ("float_share", "decimal(38,0)", False, None)] + [
    (c, "decimal(15,4)", False, None) for c in ("pe_ttm", "pe_static", "pb", "peg", "pcf", "ps")
] + [("update_time", "timestamp", True, None)]
DIVIDEND = [("symbol", "varchar", True, 10), ("ex_dividend_date", "date", True, None),
            ("name", "varchar", False, 100)] + [
    (c, "decimal(9,4)", False, None) for c in ("total_bonus_split", "bonus_share", "split_share",
                                               "cash_dividend", "dividend_yield", "eps", "bps",
                                               "capital_reserve", "undistributed_profit",
                                               "net_profit_growth")
] + [("total_shares", "bigint", False, None), ("proposal_date", "date", False, None),
     ("record_date", "date", False, None), ("progress", "varchar", False, 50),
     ("latest_announcement", "date", False, None), ("update_time", "timestamp", True, None)]
INDEX = [("trade_date", "date", True, None), ("market", "varchar", True, 10),
         ("index_value", "decimal(10,2)", False, None), ("pb", "decimal(10,4)", False, None),
         ("pb_weighted", "decimal(10,4)", False, None), ("pb_median", "decimal(10,4)", False, None),
         ("update_time", "timestamp", True, None)]


def reasons(ddl, extra=()):
    """concat_ws of the per-row violation texts ('' when none)."""
    parts = []
    for c, t, nn, ln in ddl:
        parts.append(f"case when {c} is not null and try_cast({c} as {t}) is null then 'invalid:{c}' end")
        if nn:
            parts.append(f"case when {c} is null then 'null:{c}' end")
        if ln:
            parts.append(f"case when length({c}) > {ln} then 'length:{c}' end")
    parts += list(extra)
    return "concat_ws(';', " + ", ".join(parts) + ")"


def typed(ddl, alias=""):
    """Output columns: decimals leave at their scale and one width."""
    out = []
    for c, t, _, _ in ddl:
        e = f"cast({alias}{c} as {t})"
        wide = "decimal(38," + t.split(",")[1] if t.startswith("decimal") else None
        out.append(f"cast({e} as {wide}) {c}" if wide else f"{e} {c}")
    return ", ".join(out)


_LISTED = """case when substr(code, 1, 3) in ('600', '601', '603', '605', '688', '689') then 'sh' || code
      when substr(code, 1, 3) in ('000', '001', '002', '003', '300', '301') then 'sz' || code end"""

# Halves of a feed by day: what the target holds, and the increment (some days again).
FIRST = "(seq // 1000) % 2 = 0"
SECOND = "((seq // 1000) % 2 = 1 or ((seq // 1000) % 4 = 0 and seq % 10 = 3))"


def _there(target, date):
    return f"({{0}}.symbol, {{0}}.{date}) in (select symbol, {date} from {target})" if target else "false"


def atomic(p, ddl, src, date, keep, target=None):
    """CTEs p_k (rows with reasons), p_bad, p_why and p_ok of an all-or-nothing load per symbol."""
    there = _there(target, date).format("x")
    extra = [f"case when {date} is not null and count(*) over (partition by symbol, {date}) > 1 then 'duplicate_key' end",
             f"case when {there} then 'key_in_target' end", "case when bad_date then 'unparsed_date' end"]
    return {
        f"{p}_k": f"select *, {reasons(ddl, extra)} reasons from (select * from {src} where {keep}) x",
        f"{p}_bad": f"select symbol, count(*) bad_rows from {p}_k where reasons <> '' group by symbol",
        f"{p}_why": f"""select symbol, string_agg(distinct r, ';' order by r) reasons
          from (select symbol, unnest(string_split(reasons, ';')) r from {p}_k where reasons <> '') y group by symbol""",
        f"{p}_ok": f"select * from {p}_k where symbol not in (select symbol from {p}_bad)",
    }


def batched(p, src, keep, size, target=None):
    """CTEs p_b (rows with batch and verdict), p_first and p_ok of a load in batches per symbol."""
    there = _there(target, "trade_date").format("x")
    return {
        f"{p}_b": f"""select *, (row_number() over (partition by symbol order by seq) - 1) // {size} batch,
            (reasons <> '' or {there}
             or row_number() over (partition by symbol, trade_date order by seq) > 1) bad
          from (select * from {src} where {keep}) x""",
        f"{p}_first": f"select symbol, min(batch) first_bad from {p}_b where bad group by symbol",
        f"{p}_ok": f"""select {p}_b.* from {p}_b left join {p}_first using (symbol)
          where first_bad is null or batch < first_bad""",
    }


def report(unit, offered, inserted):
    return f"""select {unit}, cast(sum(o) as bigint) offered, cast(sum(i) as bigint) inserted,
        cast(sum(o - i) as bigint) rejected
      from (select {unit}, 1 o, 0 i from {offered} union all select {unit}, 0, 1 from {inserted}) z group by {unit}"""


CTES = {
    "fb": """select event_id, ts, user_id, event_type, value, event_id % 1000 k,
        cast(floor(event_id / 1000) as integer) n from events""",
    "fbt": """select *,
        concat(case k % 5 when 0 then '600' when 1 then '000' when 2 then '688' when 3 then '301' else '830' end,
               lpad(cast(k as varchar), 3, '0')) code,
        cast(date '2024-01-01' + (case when event_type = 'purchase' and user_id % 7 = 0 and n > 0
                                       then n - 1 else n end) as date) d
      from fb""",
    "feed": """select *, case when event_type = 'error' and user_id % 10 = 0 then 'N/A' else cast(d as varchar) end dtext
      from fbt""",
    # ---------------------------------------------------------------- valuation
    "vf": """select event_id seq, code, dtext trade_date,
        case when event_type = 'signup' then '--' else cast(value as varchar) end pe,
        cast(case when value > 300 then value * 1e11 else value * 2 end as varchar) pe_ttm,
        cast(value / 8 as varchar) pb, cast(value / 3 as varchar) ps, cast(value / 7 as varchar) ps_ttm,
        cast(value / 100 as varchar) dv_ratio, cast(value / 1000 as varchar) dv_ttm,
        cast(value * 1e8 as varchar) total_mv
      from feed""",
    "vc": f"""select seq, code, {_LISTED} symbol, try_cast(trade_date as date) trade_date,
        round_even(try_cast(pe as double), 6) pe, round_even(try_cast(pe_ttm as double), 6) pe_ttm,
        round_even(try_cast(pb as double), 6) pb, round_even(try_cast(ps as double), 6) ps,
        round_even(try_cast(ps_ttm as double), 6) ps_ttm, round_even(try_cast(dv_ratio as double), 6) dv_ratio,
        round_even(try_cast(dv_ttm as double), 6) dv_ttm, round_even(try_cast(total_mv as double), 2) total_mv,
        {TS} update_time
      from vf""",
    "vk": f"""select *, {reasons(VALUATION)} reasons from vc
      where symbol is not null and trade_date is not null""",
    "vb": """select *, (row_number() over (partition by symbol order by seq) - 1) // 1000 batch,
        (reasons <> '' or row_number() over (partition by symbol, trade_date order by seq) > 1) bad
      from vk""",
    "vfirst": "select symbol, min(batch) first_bad from vb where bad group by symbol",
    # ---------------------------------------------------------------- daily bars
    "dfeed": """select event_id seq, code, dtext date, value open, value + 1 high, value / 2 low, value close,
        value * 1000 volume, case when value > 300 then value * 1e17 else value * 1e5 end amount,
        value / 10000 turnover
      from feed""",
    "dc": f"""select seq, {_LISTED} symbol, try_cast(date as date) trade_date,
        (date is not null and try_cast(date as date) is null) bad_date,
        open, high, low, close, volume, amount, turnover, {TS} update_time
      from dfeed""",
    "dkeep": "select * from dc where symbol is not null and (trade_date >= date '2010-01-01' or bad_date)",
    "dk": f"""select *, {reasons(DAILY, ["case when trade_date is not null and count(*) over (partition by symbol, trade_date) > 1 then 'duplicate_key' end",
                                          "case when bad_date then 'unparsed_date' end"])} reasons
      from dc where symbol is not null and (trade_date >= date '2010-01-01' or bad_date)""",
    "dbad": """select symbol, count(*) bad_rows from dk where reasons <> '' group by symbol""",
    "dwhy": """select symbol, string_agg(distinct r, ';' order by r) reasons
      from (select symbol, unnest(string_split(reasons, ';')) r from dk where reasons <> '') x group by symbol""",
    # files of the daily feed: what one run loaded, and what the next one is offered
    "lg_files": """select *, concat(cast(seq // 1000 as varchar), '-', cast(seq % 10 as varchar)) file from dfeed""",
    "lg_loaded": f"select * from lg_files where {FIRST}",
    "lg_offered": """select * replace (if((seq // 1000) % 4 = 0 and seq % 10 = 3, close + 1, close) as close)
      from lg_files""",
    # ---------------------------------------------------------------- share capital
    "cfeed": """select event_id seq, code, dtext data_date, cast(value as varchar) close,
        cast(value / 7 as varchar) change_pct, cast(value * 1e9 as varchar) total_mv,
        cast(value * 5e8 as varchar) circulating_mv, cast(value * 1e4 / 3 as varchar) total_share,
        cast(value * 1e4 as varchar) float_share,
        case when event_type = 'signup' then '--' else cast(value as varchar) end pe_ttm,
        cast(value * 2 as varchar) pe_static, cast(value / 3 as varchar) pb, cast(value / 11 as varchar) peg,
        cast(case when value > 300 then value * 1e12 else value * 3 end as varchar) pcf,
        cast(value / 9 as varchar) ps
      from feed""",
    "cc": f"""select seq, {_LISTED} symbol, try_cast(data_date as date) data_date,
        (data_date is not null and try_cast(data_date as date) is null) bad_date,
        round_even(try_cast(close as double), 4) close, round_even(try_cast(change_pct as double), 6) change_pct,
        round_even(try_cast(total_mv as double), 2) total_mv,
        round_even(try_cast(circulating_mv as double), 2) circulating_mv,
        round_even(try_cast(total_share as double), 0) total_share,
        round_even(try_cast(float_share as double), 0) float_share,
        round_even(try_cast(pe_ttm as double), 4) pe_ttm, round_even(try_cast(pe_static as double), 4) pe_static,
        round_even(try_cast(pb as double), 4) pb, round_even(try_cast(peg as double), 4) peg,
        round_even(try_cast(pcf as double), 4) pcf, round_even(try_cast(ps as double), 4) ps,
        {TS} update_time
      from cfeed""",
    "ckeep": "select * from cc where symbol is not null",
    "ck": f"""select *, {reasons(CAP, ["case when data_date is not null and count(*) over (partition by symbol, data_date) > 1 then 'duplicate_key' end",
                                        "case when bad_date then 'unparsed_date' end"])} reasons
      from cc where symbol is not null""",
    "cbad": "select symbol, count(*) bad_rows from ck where reasons <> '' group by symbol",
    "cwhy": """select symbol, string_agg(distinct r, ';' order by r) reasons
      from (select symbol, unnest(string_split(reasons, ';')) r from ck where reasons <> '') x group by symbol""",
    # ---------------------------------------------------------------- dividends
    "spine": """select concat(cast(y as varchar), p) report_date
      from range(2009, 2026) t(y) cross join (values ('0630'), ('1231')) v(p)""",
    "dvf": """select concat(cast(2009 + user_id % 23 as varchar),
          case when 2009 + user_id % 23 < 2014 then '1231' when event_id % 2 = 0 then '0630' else '1231' end)
          report_date,
        event_id seq, code, concat('Name', code) name, cast(value as varchar) total_bonus_split,
        cast(value / 2 as varchar) bonus_share,
        case when event_type = 'signup' then '--' else cast(value / 3 as varchar) end split_share,
        cast(value / 3 as varchar) cash_dividend,
        case when value > 300 then value * 1e4 else value / 5 end dividend_yield,
        value / 3 eps, value * 2 bps, value / 6 capital_reserve, value / 7 undistributed_profit,
        value - 50 net_profit_growth, user_id * 1000 total_shares,
        cast(d - 30 as varchar) proposal_date, cast(d - 1 as varchar) record_date, dtext ex_dividend_date,
        event_type progress, cast(d as varchar) latest_announcement
      from feed""",
    "dvc": f"""select report_date, seq, code symbol, name,
        try_cast(total_bonus_split as double) / 10 total_bonus_split, try_cast(bonus_share as double) / 10 bonus_share,
        try_cast(split_share as double) / 10 split_share, try_cast(cash_dividend as double) / 10 cash_dividend,
        dividend_yield, eps, bps, capital_reserve, undistributed_profit, net_profit_growth, total_shares,
        try_cast(proposal_date as date) proposal_date, try_cast(record_date as date) record_date,
        try_cast(ex_dividend_date as date) ex_dividend_date, progress,
        try_cast(latest_announcement as date) latest_announcement, {TS} update_time
      from dvf where report_date in (select report_date from spine)""",
    "dvk": f"select *, {reasons(DIVIDEND)} reasons from dvc",
    "dvwin": """select * from (select *, row_number() over (partition by symbol, ex_dividend_date
        order by report_date desc, seq desc) rn from dvk where reasons = '') x where rn = 1""",
    # ---------------------------------------------------------------- index
    "ix": """select case event_type when 'click' then 'SH' when 'view' then 'SZ' when 'purchase' then 'CYB'
          else 'STAR' end market,
        cast(cast(ts as date) as varchar) trade_date, max(value) index_value, min(value) pb,
        max(value) - min(value) pb_weighted, round((max(value) + min(value)) / 2, 4) pb_median
      from events where event_type <> 'error' group by 1, 2""",
    "ixc": f"""select try_cast(trade_date as date) trade_date, market, index_value, pb, pb_weighted, pb_median,
        (trade_date is not null and try_cast(trade_date as date) is null) bad_date, {TS} update_time
      from ix""",
    "ixk": f"""select *, {reasons(INDEX, ["case when trade_date is not null and count(*) over (partition by trade_date, market) > 1 then 'dup' end",
                                          "case when bad_date then 'bad' end"])} reasons from ixc""",
    # ---------------------------------------------------------------- sectors
    "sc": """select cast(o_custkey % 50 as varchar) symbol, cast(o_orderdate as date) start_date,
        case when min(o_orderpriority) = '3-MEDIUM' and o_custkey % 50 < 10 then null
             else min(o_orderpriority) end industry_code
      from orders group by o_custkey % 50, cast(o_orderdate as date)""",
    "sb": "select min(start_date) lo, max(start_date) hi from sc where start_date is not null",
    "sspine": """select s.symbol, cast(g.d as date) date
      from (select distinct symbol from sc) s cross join sb
        cross join lateral (select unnest(generate_series(cast(sb.lo as timestamp), cast(sb.hi as timestamp),
                                                          interval 1 day)) d) g""",
    "panel": """select sp.date, sp.symbol, coalesce(last_value(sc.industry_code ignore nulls) over (
          partition by sp.symbol order by sp.date rows between unbounded preceding and current row), 'UNK')
          industry_code
      from sspine sp left join sc on sc.symbol = sp.symbol and sc.start_date = sp.date""",
    "mapping": """select distinct o_orderpriority industry_code,
        case when o_orderpriority = '4-NOT SPECIFIED' then null else substr(o_orderpriority, 1, 1) end level1,
        substr(o_orderpriority, 3) level3
      from orders where o_orderpriority <> '5-LOW'""",
}
CTES |= {
    "codes": """select distinct concat(case when k >= 1000 then '605' when k % 5 = 0 then '600' when k % 5 = 1 then '000'
          when k % 5 = 2 then '688' when k % 5 = 3 then '301' else '830' end,
        lpad(cast(k % 1000 as varchar), 3, '0')) code
      from (select p_partkey % 1200 k from part) pk""",
    "vlist": "select * from vk where code in (select code from codes)",
    **atomic("d1", DAILY, "dkeep", "trade_date", FIRST),
    **atomic("d2", DAILY, "dkeep", "trade_date", SECOND, "d1_ok"),
    **atomic("c1", CAP, "ckeep", "data_date", FIRST),
    **atomic("c2", CAP, "ckeep", "data_date", SECOND, "c1_ok"),
    **batched("v1", "vlist", FIRST, 1000),
    **batched("v2", "vlist", SECOND, 2, "v1_ok"),
    **batched("v3", "vk", "true", 2),
    "dv1": f"""select * from dvk where reasons = '' and {FIRST} qualify row_number() over (
        partition by symbol, ex_dividend_date order by report_date desc, seq desc) = 1""",
    "dv2": f"""select * from dvk where reasons = '' and {SECOND} qualify row_number() over (
        partition by symbol, ex_dividend_date order by report_date desc, seq desc) = 1""",
    "dvm": """select * from dv2 union all
      select * from dv1 where (symbol, ex_dividend_date) not in (select symbol, ex_dividend_date from dv2)""",
    "ixbig": f"""select *, {reasons(INDEX)} reasons
      from (select * replace (if(market = 'SZ', index_value * 1e9, index_value) as index_value) from ixc) x""",
}
ALL = list(CTES)


def m(body, **extra):
    """The statement with the CTEs that it needs, in order."""
    text, need = " ".join([body, *extra.values()]), set()
    for name in reversed(ALL):
        if re.search(rf"\b{name}\b", text):
            need.add(name)
            text += " " + CTES[name]
    return with_ctes(CTES, [n for n in ALL if n in need], body, **extra)


ETL_SQL = {
    "sector_changes": m("select symbol, start_date, industry_code from sc where start_date is not null"),
    "sector_code_panel": m("select date, symbol, industry_code from panel"),
    "sector_and_industry": m("""select p.date, p.symbol,
        case when p.industry_code = 'UNK' then 'UNK' else coalesce(mp.level1, 'UNK') end sector,
        case when p.industry_code = 'UNK' then 'UNK' else coalesce(mp.level3, 'UNK') end industry
      from panel p left join mapping mp on mp.industry_code = p.industry_code"""),
    "listed_codes": m(f"select code, {_LISTED} symbol from codes where {_LISTED} is not null"),
    "listed_without_data": m(f"""select code from codes
      where {_LISTED} is not null and code not in (select code from vf)"""),
    "sector_change_conflicts": m("""select symbol, start_date, count(*) as rows, min(code) least_code,
        max(code) greatest_code
      from (select distinct cast(o_custkey % 50 as varchar) symbol, cast(o_orderdate as date) start_date,
              o_orderpriority code from orders) x
      group by symbol, start_date having count(*) > 1"""),
    "sector_panel_wide": m("select date, " + ", ".join(
        f"max(industry_code) filter (where symbol = '{k}') symbol_{k}" for k in (0, 1, 7, 13, 42))
        + " from panel group by date"),
    "index_feed": m("select trade_date, index_value, pb, pb_weighted, pb_median, market from ix"),
    "ingest_index_valuation": m(f"""select {typed(INDEX)} from ixk
      where (select count(*) from ixk where reasons <> '') = 0"""),
    "valuation_rejects": m("select seq, symbol, trade_date, reasons reason from vk where reasons <> ''"),
    "ingest_valuation": m(f"""select {typed(VALUATION, 'vb.')} from vb left join vfirst using (symbol)
      where vfirst.first_bad is null or vb.batch < vfirst.first_bad"""),
    "valuation_failed_batches": m("""select symbol, min(first_bad) first_bad_batch, count(*) dropped_rows
      from vb join vfirst using (symbol) where vb.batch >= vfirst.first_bad group by symbol"""),
    "ingest_daily_bars": m(f"select {typed(DAILY)} from dk where symbol not in (select symbol from dbad)"),
    "daily_bar_failed_symbols": m("select symbol, bad_rows, reasons from dbad join dwhy using (symbol)"),
    "load_ledger": m(f"""select file, count(*) as "rows",
        case when file not in (select file from lg_loaded) then 'new'
             when file in (select file from (
                (select * from lg_offered except all select * from lg_loaded) union all
                (select * from lg_loaded except all select * from lg_offered)) x) then 'conflict'
             else 'repeat' end as status
      from lg_offered group by file"""),
    "daily_bar_load_report": m(report("symbol", "dk", "(select * from dk where symbol not in (select symbol from dbad))")),
    "daily_bar_increment": m(f"select {typed(DAILY)} from d2_ok"),
    "daily_bar_increment_failed_symbols": m("select symbol, bad_rows, reasons from d2_bad join d2_why using (symbol)"),
    "share_capital_increment": m(f"select {typed(CAP)} from c2_ok"),
    "share_capital_load_report": m(report("symbol", "ck", "(select * from ck where symbol not in (select symbol from cbad))")),
    "valuation_increment": m(f"select {typed(VALUATION)} from v2_ok"),
    "valuation_increment_failed_batches": m("""select symbol, min(first_bad) first_bad_batch,
        count(*) filter (where batch >= first_bad) dropped_rows
      from v2_b join v2_first using (symbol) group by symbol"""),
    "valuation_load_report": m(report("symbol", "vk", "v3_ok")),
    "dividend_merge": m(f"select {typed(DIVIDEND)} from dvm"),
    "dividend_load_report": m(report("report_date", "dvk", "(select * from dvk where reasons = '')")),
    "index_load_rejects": m("""select trade_date, market, cast(1 as bigint) bad_rows, reasons
      from ixbig where reasons <> ''"""),
    "index_load_report": m(report("market", "ixbig", """(select * from ixbig
        where (select count(*) from ixbig where reasons <> '') = 0)""")),
    "ingest_share_capital": m(f"select {typed(CAP)} from ck where symbol not in (select symbol from cbad)"),
    "share_capital_failed_symbols": m("select symbol, bad_rows, reasons from cbad join cwhy using (symbol)"),
    "ingest_dividends": m(f"select {typed(DIVIDEND)} from dvwin"),
    "dividend_rejects": m("""select report_date, seq, symbol, ex_dividend_date, reasons reason
      from dvk where reasons <> ''"""),
    "missing_dividend_periods": m("""select report_date from spine
      where report_date not in (select distinct report_date from dvf)"""),
}
