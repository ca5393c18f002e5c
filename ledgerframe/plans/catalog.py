"""The full query registry (merged from the per-domain catalogs)."""

from __future__ import annotations


def all_queries():
    from ledgerframe.plans.market_catalog import QUERIES as market
    from ledgerframe.plans.music_catalog import QUERIES as music
    from ledgerframe.plans.etl_catalog import QUERIES as etl
    out = {}
    for part in (market, music, etl):
        dup = set(out) & set(part)
        if dup:
            raise ValueError(f"duplicate query keys: {sorted(dup)}")
        out.update(part)
    return out
