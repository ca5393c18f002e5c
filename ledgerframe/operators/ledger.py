"""Load ledger (A16, A19): what each job has loaded, so that a job may run twice.

A job's rows are told apart by unit (symbol, report period, ...). The ledger has one row per
loaded unit with the number of its rows and a hash of their content that doesn't depend on
their order. A unit offered again with the same content is a repeat and is left out, so a
job that lost its driver after the load is simply run again; a unit whose content differs
from what was loaded is a conflict that the caller must decide on; others are new.

The hash adds up row hashes, so equal rows count as often as they stand there and a hot
unit is added up before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SCHEMA = "job string, unit string, rows long, content decimal(38,0)"


def contents(feed: DataFrame, job: str, unit: str, columns: list[str] | None = None) -> DataFrame:
    """Ledger rows of a feed: ``job, unit, rows, content``."""
    # the row hash skips nulls, so each column says whether it is one
    cells = [c for name in columns or feed.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return (feed.groupBy(F.col(unit).cast("string").alias("unit"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*cells).cast("decimal(38,0)")).alias("content"))
            .select(F.lit(job).alias("job"), "unit", "rows", "content"))


def compare(feed: DataFrame, ledger: DataFrame, job: str, unit: str, columns: list[str] | None = None) -> DataFrame:
    """``unit, rows, status`` of each offered unit: ``new``, ``repeat`` or ``conflict``."""
    offered = contents(feed, job, unit, columns)
    known = ledger.filter(F.col("job") == job).select(
        F.col("unit").alias("_unit"), F.col("rows").alias("_rows"), F.col("content").alias("_content"))
    same = (F.col("rows") == F.col("_rows")) & (F.col("content") == F.col("_content"))
    both = offered.join(known, F.col("unit").eqNullSafe(F.col("_unit")), "left")
    status = F.when(F.col("_rows").isNull(), "new").when(same, "repeat").otherwise("conflict")
    return both.select("unit", "rows", status.alias("status"))


def not_loaded(feed: DataFrame, ledger: DataFrame, job: str, unit: str, columns: list[str] | None = None) -> DataFrame:
    """The feed without the units that were loaded as they are. A conflict raises when the plan runs."""
    found = compare(feed, ledger, job, unit, columns)
    refuse = F.raise_error(F.concat(F.lit(f"{job}: loaded with other rows before: "), F.col("unit"))).cast("boolean")
    known = found.filter("status <> 'new'").filter(F.when(F.col("status") == "conflict", refuse).otherwise(F.lit(True)))
    known = known.select(F.col("unit").alias("_known"))
    return feed.join(known, F.col(f"`{unit}`").cast("string").eqNullSafe(F.col("_known")), "left_anti")
