"""Point-in-time sector classification panel (K44, K45) and its inputs (A2).

The reference pivots change rows into a dense date x symbol matrix, re-indexes it to
every calendar day, forward-fills and maps each cell through a Python dict. Here the
panel stays long (date, symbol, code): a generated day spine per symbol is unioned
with the change rows and ``last(code, ignorenulls)`` runs per symbol; the mapping is a
broadcast join. The wide form is an optional last step with an explicit column list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerframe.functions.cleaning import rename_columns
from ledgerframe.functions.vendor import SECTOR_MAPPING_HEADERS

UNK = "UNK"   # fixed value: the reference's placeholder for "no classification"


def load_sector_changes(table: DataFrame) -> DataFrame:
    """A2: symbol, start_date (date), industry_code; rows without a start date dropped."""
    return (table.select("symbol", F.col("start_date").cast("date").alias("start_date"), "industry_code")
            .filter(F.col("start_date").isNotNull()))


def _bound(changes: DataFrame, value, default: Column) -> Column:
    """A literal date, or a scalar subquery over ``changes`` (an aggregate Column)."""
    if value is None:
        value = default
    if isinstance(value, Column):
        return changes.select(value).scalar()
    return F.lit(str(value)).cast("date")


def sector_code_panel(changes: DataFrame, start=None, end=None) -> DataFrame:
    """Date, symbol, industry_code for every day in [start, end] and every symbol
    in ``changes``; a code holds from its start date until the next change; NULL codes
    do not interrupt the previous one; days before a symbol's first code are 'UNK'.

    ``start`` defaults to the first change date; ``end`` defaults to today (as the
    reference) and may be passed as a date, text or Column. Changes outside the range
    are ignored, so a later start forgets earlier codes (the reference re-indexes
    before filling). (symbol, start_date) must be unique, as the reference's pivot demands:
    a repeated pair raises when the plan runs (``change_conflicts`` lists them).
    """
    lo = _bound(changes, start, F.min("start_date"))
    hi = _bound(changes, end, F.max(F.current_date()))
    # one event per (symbol, day), so a symbol's window never holds more than two rows a day
    repeated = F.raise_error(F.concat(F.lit("sector changes are not unique: symbol "), F.col("symbol"),
                                      F.lit(" on "), F.col("date").cast("string"))).cast("string")
    events = (changes.filter(F.col("start_date").between(lo, hi))
              .groupBy(F.col("start_date").alias("date"), "symbol")
              .agg(F.max("industry_code").alias("_code"), F.count(F.lit(1)).alias("_rows"))
              .select("date", "symbol", F.when(F.col("_rows") > 1, repeated).otherwise(F.col("_code")).alias("_code"),
                      F.lit(0).alias("_spine")))
    spine = (changes.select("symbol").distinct().filter(lo <= hi)
             .select(F.explode(F.sequence(lo, hi)).alias("date"), "symbol",
                     F.lit(None).cast("string").alias("_code"), F.lit(1).alias("_spine")))
    # a change on day d is seen by the spine row of day d (events sort first)
    w = (Window.partitionBy("symbol").orderBy("date", "_spine")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = events.unionByName(spine).withColumn("industry_code", F.last("_code", ignorenulls=True).over(w))
    return (filled.filter(F.col("_spine") == 1)
            .select("date", "symbol", F.coalesce("industry_code", F.lit(UNK)).alias("industry_code")))


def change_conflicts(changes: DataFrame) -> DataFrame:
    """A14 for K44: the (symbol, start_date) pairs that stand in several change rows, with
    the number of rows and the least and greatest code."""
    return (changes.groupBy("symbol", "start_date")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("industry_code").alias("least_code"),
                 F.max("industry_code").alias("greatest_code"))
            .filter(F.col("rows") > 1))


def load_mapping(mapping: DataFrame) -> DataFrame:
    """industry_code -> level1..level3 with missing names as 'UNK' (mapping file load;
    the vendor's headers are renamed first)."""
    mapping = rename_columns(mapping, SECTOR_MAPPING_HEADERS)
    return mapping.select("industry_code", *[F.coalesce(F.col(c), F.lit(UNK)).alias(c)
                                             for c in ("level1", "level2", "level3")])


def sector_and_industry(panel: DataFrame, mapping: DataFrame) -> DataFrame:
    """Level-1 (sector) and level-3 (industry) names per panel cell, 'UNK' for
    'UNK' codes and codes missing from the mapping (one row per code)."""
    m = load_mapping(mapping).select("industry_code", "level1", "level3")
    j = panel.join(m, "industry_code", "left")
    known = F.col("industry_code") != F.lit(UNK)
    return j.select("date", "symbol",
                    F.when(known, F.coalesce("level1", F.lit(UNK))).otherwise(F.lit(UNK)).alias("sector"),
                    F.when(known, F.coalesce("level3", F.lit(UNK))).otherwise(F.lit(UNK)).alias("industry"))


def pivot_panel(panel: DataFrame, value_col: str, symbols: list[str]) -> DataFrame:
    """Wide date x symbol form with an explicit column list (no extra job to discover
    the symbols); keep the long form for anything downstream."""
    return panel.groupBy("date").pivot("symbol", symbols).agg(F.first(value_col))
