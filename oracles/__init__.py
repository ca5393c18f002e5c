"""Independent DuckDB SQL for every registered query.

Each oracle derives the reference's tables from the driver's views with the
FIXTURES.md recipes (as CTEs) and then states the reference's query in its literal
form (theta joins, self-joins, single windows), so it checks the Spark rewrites
rather than repeating them. Decimal outputs are cast to DOUBLE, matching
``ledgerframe.functions.output.comparable``.
"""


def all_oracles() -> dict[str, str]:
    from oracles.market import MARKET_SQL
    from oracles.music import MUSIC_SQL
    from oracles.etl import ETL_SQL
    out = {}
    for part in (MARKET_SQL, MUSIC_SQL, ETL_SQL):
        out.update(part)
    return out
