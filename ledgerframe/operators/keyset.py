"""Key filter: a set of keys as the bits of one fixed-size array, probed where rows are read.

A load touches few of a large target's rows. The keys it brings are hashed into ``2 ** BITS``
bits, an aggregate of at most ``2 ** (BITS - 6)`` numbers that becomes a scalar subquery; the
target's rows test their own key against it inside the scan's stage. Rows that the filter
rules out need no join and no shuffle. The filter may let a row pass whose key isn't in the
set, never rule one out that is, so an exact join decides on the rest. With far more keys
than bits it lets all rows pass and costs a shuffle, no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 20


def _place(keys: list[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def key_bits(rows: DataFrame, keys: list[str], bits: int = BITS) -> Column:
    """The rows' keys as an array of 64-bit words (a scalar subquery)."""
    at = rows.select(_place(keys, bits).alias("p"))
    words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    every = rows.sparkSession.range(1 << (bits - 6)).select(F.col("id").alias("w"))
    dense = every.join(words, "w", "left").select("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"])).scalar()


def may_hold(words: Column, keys: list[str], bits: int = BITS) -> Column:
    """True for rows whose key may be in the set; never false or null for one that is."""
    p = _place(keys, bits)
    word = F.get(words, F.shiftright(p, 6).cast("int"))
    return F.getbit(word, p.bitwiseAND(F.lit(63)).cast("int")) == 1
