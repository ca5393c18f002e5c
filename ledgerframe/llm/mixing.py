"""Mixing sources to target weights (operator 5), DataFrame functions only.

Each source's documents are laid end to end and packed into blocks of ``block_words``
words. Every output shard draws multinomial source counts: each of its slots picks a
source at random with the sources' allotments as weights, and the picks are counted. A
source's draws are numbered over the shards, and draw ``j`` reads block
``permutation(j mod blocks)`` of pass ``j div blocks``; blocks and draws are joined by
index. Draws beyond a source's allotment are released, and a last make-up shard draws
what is still missing, so that a source meets its target to within a block and no block
is read more than twice.

Running sums are two-level: within (source, bucket) and over the buckets' totals. A
source with a third of all rows is thereby spread over ``BUCKETS`` windows.

Defined cases: a null or empty text has size 0 and nothing is taken from it; a null
source is a source of its own, last in order; repeated rows are separate documents; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerframe.llm.common import cut

#: Fixed by the contract: words, weights in turn, the mix's size and the repeat limit.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MIX_SHARE = 1.5
MAX_REPEATS = 2

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
BUCKETS = 4096
_BINS = 1024
#: Rounds of the index permutations: each swaps about half of the pairs of a random pairing.
ROUNDS = 32
#: Primes above any block count, so prime to it: multipliers of the index permutations.
_PRIMES = (1_099_511_627_791, 2_199_023_255_579, 4_398_046_511_119, 8_796_093_022_237)


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """``(doc_id, source, src, size)``; ``src`` is a source key without nulls."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("src"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, block_words: int = BLOCK_WORDS, weights: tuple = WEIGHTS,
            share: float = MIX_SHARE, repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``src, source_size, target, blocks, allot``.

    Sharing the excess until nobody is above the limit ends at ``min(limit, level *
    weight)`` with one level for all. With sources in order of limit per weight, the level
    is the greatest of the shares that result when the first k sources are at their limit.
    """
    total = sized.groupBy("src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    everything = Window.partitionBy()  # one row per source
    ordered = everything.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.row_number().over(ordered) - 1) % len(weights) + 1)
    s = total.withColumn("weight", weight).withColumn("limit", repeats * F.col("source_size"))
    by_limit = everything.orderBy(F.col("limit") / F.col("weight"), "src")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level_here", (share * F.sum("source_size").over(everything)
                                    - F.coalesce(F.sum("limit").over(before), F.lit(0)))
                     / F.sum("weight").over(after))
    s = s.withColumn("level", F.max("level_here").over(everything))
    s = s.withColumn("target", F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")))
    blocks = F.ceil(F.col("source_size") / block_words)
    allot = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))) \
        .otherwise(0)
    return s.withColumn("blocks", blocks.cast("long")).withColumn("allot", allot.cast("long")) \
        .select("src", "source_size", "target", "blocks", "allot")


def _running(df: DataFrame, bucket: Column, order: list, value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before each row of its ``src``.

    The order is by bucket, then by ``order`` within it.
    """
    df = df.withColumn("_bucket", bucket)
    within = Window.partitionBy("src", "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (df.groupBy("src", "_bucket").agg(F.sum(value).alias("_sum"))
            .withColumn("_base", F.coalesce(F.sum("_sum").over(over), F.lit(0))).drop("_sum"))
    return (df.withColumn("_in", F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(base, ["src", "_bucket"])
            .withColumn(out, F.col("_in") + F.col("_base")).drop("_bucket", "_in", "_base"))


def _times(a: Column, x: Column, n: Column) -> Column:
    """a * x mod n in 64 bits, for n below 2**40 and a, x below n."""
    high = F.pmod(F.shiftright(a, 20) * x, n)
    low = a.bitwiseAND(F.lit((1 << 20) - 1)) * x
    return F.pmod(F.pmod(F.shiftleft(high, 20), n) + F.pmod(low, n), n)


def permuted(j: Column, n: Column, src: Column, seed: int) -> Column:
    """Block of draw j: a pseudorandom permutation of 0..n-1 for each source and pass.

    Swap-or-not shuffle: in each round a random key pairs x with key - x, and a hash of the
    pair says whether its two change places. This holds for any n, and a block is
    computed from its index alone. The rounds start from an affine map.
    """
    turn, at = F.floor(j / n), F.pmod(j, n)
    key = F.xxhash64(F.lit(seed), src, turn)
    prime = F.element_at(F.array(*map(F.lit, _PRIMES)), (F.pmod(key, F.lit(len(_PRIMES))) + 1).cast("int"))
    shift = F.pmod(F.xxhash64(F.lit(seed + 1), src, turn), n)
    start = F.pmod(_times(F.pmod(prime, n), at, n) + shift, n)

    def swapped(x: Column, turn_key: Column) -> Column:
        other = F.pmod(F.pmod(turn_key, n) - x, n)
        swap = F.xxhash64(turn_key, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    keys = F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: F.xxhash64(key, r))
    return F.aggregate(keys, start, swapped)


def draws(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 5) -> DataFrame:
    """``(src, shard, draw, block)``: the blocks that the mix reads, shard by shard."""
    spark = sources.sparkSession
    slots = sources.agg(F.coalesce(F.sum("allot"), F.lit(0))).first()[0]
    width = max(1, -(-slots // _BINS))
    upto = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)  # one row per source
    bounds = (sources.where("allot > 0").withColumn("hi", F.sum("allot").over(upto))
              .withColumn("lo", F.col("hi") - F.col("allot"))
              .select("src", "lo", "hi", F.explode(F.sequence(
                  F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("bin")))
    picks = (spark.range(slots)
             .select(F.floor(F.col("id") / shard_slots).alias("shard"),
                     F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, slots))).alias("x"))
             .withColumn("bin", F.floor(F.col("x") / width)))
    counts = (picks.join(bounds, "bin").where("x >= lo and x < hi")
              .groupBy("src", "shard").agg(F.count("*").alias("n")))
    counts = cut(counts)
    numbered = _running(counts, F.floor(F.col("shard") / BUCKETS), ["shard"], "n", "start")
    drawn = counts.groupBy("src").agg(F.sum("n").alias("drawn"))
    make_up = (sources.join(drawn, "src", "left")
               .withColumn("start", F.coalesce("drawn", F.lit(0)))
               .where("allot > start")
               .select("src", F.lit(None).cast("long").alias("shard"), "start",
                       (F.col("allot") - F.col("start")).alias("n")))
    plan = numbered.select("src", "shard", "start", "n").unionByName(make_up)
    plan = (plan.join(sources.select("src", "blocks", "allot"), "src")
            .withColumn("stop", F.least(F.col("start") + F.col("n"), "allot"))
            .where("start < stop"))
    # few small rows stand for many draws, so their number of tasks is not left to their bytes
    plan = plan.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "src", "shard")
    return (plan.select("src", "shard", "blocks",
                        F.explode(F.sequence(F.col("start"), F.col("stop") - 1)).alias("draw"))
            .withColumn("block", permuted(F.col("draw"), F.col("blocks"), F.col("src"), seed))
            .drop("blocks"))


def pieces(sized: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each document's share of each block: ``src, block, start, doc_id, source, size, first_word, words``.

    ``start`` is the document's first word in its source, which tells documents apart.
    """
    laid = _running(sized.where("size > 0"), F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)),
                    ["doc_id", "size"], "size", "start")
    at = (laid.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block_words),
        F.floor((F.col("start") + F.col("size") - 1) / block_words))))
        .withColumn("from", F.greatest("start", F.col("block") * block_words))
        .withColumn("to", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)))
    return at.select("src", "block", "start", "doc_id", "source", "size",
                     (F.col("from") - F.col("start")).alias("first_word"),
                     (F.col("to") - F.col("from")).alias("words"))


def mixed_pieces(docs: DataFrame, **names) -> DataFrame:
    """The mix itself: which words of which document each shard reads, in draw order."""
    sized = cut(sizes(docs, **names))
    return (draws(cut(targets(sized))).join(pieces(sized), ["src", "block"])
            .select("shard", "draw", "source", "block", "doc_id", "first_word", "words"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 5) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per document."""
    sized = cut(sizes(docs, id_col, text_col, source_col))
    sources = cut(targets(sized, block_words))
    read = draws(sources, shard_slots, seed).groupBy("src", "block").agg(F.count("*").alias("times"))
    part = pieces(sized, block_words).join(read, ["src", "block"], "left")
    taken = (part.groupBy("src", "start", "doc_id", "size")
             .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")))
    rows = taken.select("src", "doc_id", "size", "taken").unionByName(
        sized.where("size = 0").select("src", "doc_id", "size", F.lit(0).cast("long").alias("taken")))
    return (rows.join(sources, "src")
            .select(F.col("doc_id").alias(id_col), "size", "source_size", "target", "taken"))
