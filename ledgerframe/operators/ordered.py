"""Running aggregates and lags over one global order, without a one-task window.

``sum(x) over (order by d)`` with no partition key makes Spark move every row into a
single partition. The reference computes NAV (a running sum of P&L), the running peak
of NAV and 29/89-row lags this way. Here each is done in two levels:

1. rows are cut into blocks by a monotone function of the order key (month by
   default); a window *partitioned by block* gives the in-block prefix;
2. one row per block carries the block total (sum / max / row count); a tiny window
   over those block rows gives the carry-in of all earlier blocks, broadcast back
   (its size is the number of blocks, i.e. months in the date range).

Results equal the single-window form (checked against the literal SQL in the oracle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_B = "_blk"


def _month_block(order_col: str) -> Column:
    return F.trunc(F.col(order_col), "month")


def running_sum(df: DataFrame, order_col: str, value_col: str, out_col: str,
                block: Column | None = None) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over all rows whose ``order_col`` is <=
    this row's (RANGE frame: equal keys are peers, as a ``>=`` self-join would count)."""
    blk = block if block is not None else _month_block(order_col)
    d = df.withColumn(_B, blk)
    totals = d.groupBy(_B).agg(F.sum(value_col).alias("_bt"))
    carry_w = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(_B, F.coalesce(F.sum("_bt").over(carry_w), F.lit(0)).alias("_carry"))
    in_blk = Window.partitionBy(_B).orderBy(order_col).rangeBetween(Window.unboundedPreceding, 0)
    return (d.join(F.broadcast(carry), _B)
            .withColumn(out_col, F.col("_carry") + F.sum(value_col).over(in_blk))
            .drop(_B, "_carry"))


def running_max(df: DataFrame, order_col: str, value_col: str, out_col: str,
                block: Column | None = None) -> DataFrame:
    """Add ``out_col`` = max of ``value_col`` over rows unbounded preceding .. current
    (ROWS frame in ``order_col`` order)."""
    blk = block if block is not None else _month_block(order_col)
    d = df.withColumn(_B, blk)
    totals = d.groupBy(_B).agg(F.max(value_col).alias("_bm"))
    carry_w = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(_B, F.max("_bm").over(carry_w).alias("_carry"))
    in_blk = Window.partitionBy(_B).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    # greatest() skips NULL, so the first block (no carry) keeps its own running max
    return (d.join(F.broadcast(carry), _B)
            .withColumn(out_col, F.greatest(F.col("_carry"), F.max(value_col).over(in_blk)))
            .drop(_B, "_carry"))


def global_row_index(df: DataFrame, order_col: str, out_col: str = "_idx",
                     block: Column | None = None, partition: list[str] | None = None) -> DataFrame:
    """1-based position of each row in ``order_col`` order (ties broken arbitrarily,
    as ``row_number`` does), from per-block counts plus an in-block row_number.
    With ``partition`` the numbering restarts per partition key; a key with many rows
    is still numbered by one task per (key, block), not one task per key."""
    part = list(partition or [])
    blk = block if block is not None else _month_block(order_col)
    d = df.withColumn(_B, blk)
    counts = d.groupBy(*part, _B).agg(F.count(F.lit(1)).alias("_bn"))
    carry_w = Window.partitionBy(*part).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = counts.select(*part, _B, F.coalesce(F.sum("_bn").over(carry_w), F.lit(0)).alias("_carry"))
    in_blk = Window.partitionBy(*part, _B).orderBy(order_col)
    # one carry row per (key, block): small next to the rows it numbers
    carry_side = carry if part else F.broadcast(carry)
    return (d.join(carry_side, [*part, _B])
            .withColumn(out_col, F.col("_carry") + F.row_number().over(in_blk))
            .drop(_B, "_carry"))


def global_lags(df: DataFrame, order_col: str, value_col: str,
                lags: dict[str, int]) -> DataFrame:
    """For each ``name: n`` add ``name`` = ``value_col`` of the row n positions earlier
    in ``order_col`` order (NULL for the first n rows), like ``lag(value, n)`` with no
    partition. Implemented as equi-joins on a global row index, so no row set is ever
    gathered into one task."""
    idx = global_row_index(df, order_col, "_idx")
    out = idx
    for name, n in lags.items():
        prev = idx.select((F.col("_idx") + F.lit(n)).alias("_idx"), F.col(value_col).alias(name))
        out = out.join(prev, "_idx", "left")
    return out.drop("_idx")
