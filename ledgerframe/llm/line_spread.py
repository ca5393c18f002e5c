"""Line dedup by distinct-site spread (operator 9).

For every line, a HyperLogLog sketch of the sites it stands on is merged by
aggregation. Lines whose estimate is clearly above ``min_sites`` are boilerplate; lines
near the threshold get an exact distinct count of sites. Boilerplate lines are removed
from all documents.

A line's sites are those of the different texts that hold it: copies of one text count as
one text, on the least of their sites. So the lines of a mirrored page don't spread by the
mirrors alone, and the page stays whole for document near-dedup to handle, while a line of
many different texts goes from all documents, whatever its share of them. Lines are
compared without white space at either end; blank lines neither count nor go.

Defined cases: a null text stays null and an empty one empty; a null site is a site of
its own; positions are found per text, so repeated rows and null or repeated ids are
treated alike; an empty table gives an empty result; all columns of the input are
returned, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerframe.llm.common import cut, stored

MIN_SITES = 8
#: Sketch size (log2 of registers) and the band of exact counting around the threshold,
#: in standard errors of the sketch.
LOG_REGISTERS = 10
BAND = 4.0
BLANK = " \t\r\x0b\x0c"
#: Texts that hold this share (1 / HOT_TEXTS) of all rows get their cuts by broadcast: that many at most.
HOT_TEXTS = 1000


def _pair(x: Column, name: str) -> list[Column]:
    """96 bits that stand for a string."""
    return [F.xxhash64(x).alias(f"{name}1"), F.crc32(x).alias(f"{name}2")]


def lines(docs: DataFrame, text_col: str, site_col: str) -> DataFrame:
    """``(t1, t2, pos, k1, k2, site)`` for each line of a text that isn't blank; t stands for the text, k for the line.

    Equal texts are folded; ``site`` is the least of theirs.
    """
    site = F.coalesce(F.concat(F.lit("="), F.col(site_col).cast("string")), F.lit(""))
    split = docs.select(*_pair(F.col(text_col), "t"), site.alias("site"),
                        F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
    line = F.btrim(F.col("line"), F.lit(BLANK))
    rows = split.where(line != "").select("t1", "t2", "site", "pos", *_pair(line, "k"))
    return rows.groupBy("t1", "t2", "pos", "k1", "k2").agg(F.min("site").alias("site"))


def boilerplate(spread: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(k1, k2)`` of the lines that stand on ``min_sites`` sites or more."""
    error = 1.04 / (1 << LOG_REGISTERS) ** 0.5
    low, high = min_sites * (1 - BAND * error) - 0.5, min_sites * (1 + BAND * error) + 0.5
    estimate = (spread.groupBy("k1", "k2")
                .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_REGISTERS)).alias("sites")))
    estimate = cut(estimate.where(F.col("sites") >= low))
    sure = estimate.where(F.col("sites") > high).select("k1", "k2")
    near = estimate.where(F.col("sites") <= high).select("k1", "k2")
    # a line's sites once each before the join, however often it stands on them
    exact = (spread.select("k1", "k2", "site").distinct().join(near, ["k1", "k2"], "left_semi")
             .groupBy("k1", "k2").agg(F.count("site").alias("sites"))
             .where(F.col("sites") >= min_sites).select("k1", "k2"))
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, text_col: str = "text", site_col: str = "source",
                       min_sites: int = MIN_SITES) -> DataFrame:
    """``(row, text, removed)`` per input row: all of its columns, the cleaned text, and the lines taken out."""
    spread = stored(lines(docs, text_col, site_col))
    found = boilerplate(spread, min_sites)
    at = (spread.join(found, ["k1", "k2"]).groupBy("t1", "t2")
          .agg(F.collect_set("pos").alias("at")))  # at most the lines of one text
    at = stored(at)
    rows = docs.select(F.struct("*").alias("row"), *_pair(F.col(text_col), "t"))
    copies = rows.groupBy("t1", "t2").agg(F.count("*").alias("n"))
    hot = copies.where(F.col("n") * HOT_TEXTS >= max(HOT_TEXTS, docs.count())).select("t1", "t2")
    hot = F.broadcast(cut(hot.join(at, ["t1", "t2"], "left")))
    marked = rows.join(hot, ["t1", "t2"]).unionByName(
        # texts with found lines grow with the documents, so they are never broadcast: the same join at every size
        rows.join(hot.select("t1", "t2"), ["t1", "t2"], "left_anti").join(at.hint("merge"), ["t1", "t2"], "left"))
    old = F.col("row")[text_col]
    kept = F.array_join(F.filter(F.split(old, "\n"), lambda x, i: ~F.array_contains(F.col("at"), i)), "\n")
    return marked.select("row", F.when(F.col("at").isNotNull(), kept).otherwise(old).alias("text"),
                         F.when(F.col("at").isNotNull(), F.size("at")).otherwise(0).cast("long").alias("removed"))


def clean(docs: DataFrame, text_col: str = "text", site_col: str = "source", length_col: str = "n_chars",
          min_sites: int = MIN_SITES) -> DataFrame:
    """The input's columns with cleaned texts; ``length_col``, if there, follows the text."""
    out = remove_boilerplate(docs, text_col, site_col, min_sites)
    new = {text_col: F.col("text")}
    if length_col in docs.columns:
        new[length_col] = F.when(F.col("removed") > 0, F.length("text")) \
            .otherwise(F.col("row")[length_col]).cast(docs.schema[length_col].dataType)
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
