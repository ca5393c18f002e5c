"""Source divergence audit by Gustavson row accumulation (operator 13).

Each (language, source) group has a smoothed share for each term that its language keeps.
The distance of two groups is the sum of absolute differences of their shares over all
kept terms, as in a product of the group-term matrix with its transpose. A block of a
language's terms is held as two indexes, by group and by term. Row by row, a group scatters
its terms through the term-major index into a dense accumulator with one number for
each peer, so no pair of postings becomes a row. A group's share of a term that it lacks is
its baseline, the same for all such terms: terms that one side lacks are counted from the
sorted shares of the other side at once, those that both lack by their number, and the
scattered postings correct what the baselines counted for terms that both have.
Blocks' accumulators are added up by Spark.

All numbers are whole. Shares are parts of 1,000,000,000, so a block's sums stay below
2 ** 53 and are exact in floating point as well.

Defined cases: null texts, languages and sources are the empty string; a group without terms is a
group with all counts zero; in a language that keeps no term all distances are 0 and no
term is reported; repeated rows count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerframe.llm.common import cut, join_groups, stored

MIN_DOCS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
#: Postings of a block on average, and terms at most that a row scatters at a time.
BLOCK_CELLS = 200_000
_SCATTER = 1 << 20
_SALTS = 64
#: Entries that a task counts before it hands them on.
_HELD = 400_000
_TERM = re.compile(rb"[a-z\x80-\xff]+")  # of lower-cased UTF-8


def counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents, in parts; an empty term marks each group."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                        ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurs: dict = defaultdict(Counter)
        holds: dict = defaultdict(Counter)
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for group, terms in holds.items():
                many = len(terms)
                yield pa.record_batch([
                    pa.repeat(pa.scalar(group[0], pa.string()), many), pa.repeat(pa.scalar(group[1], pa.string()), many),
                    pa.array(terms.keys(), pa.binary()).cast(pa.string()),
                    pa.array(map(occurs[group].__getitem__, terms.keys()), pa.int64()),
                    pa.array(terms.values(), pa.int64())], schema=schema)
            occurs.clear()
            holds.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "t"))):
                found = _TERM.findall(text.encode().lower())
                mine = holds[lang, source]
                size -= len(mine)
                mine.update({b"", *found})
                size += len(mine)
                occurs[lang, source].update(found)
                if size >= _HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
            for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "t"))]
    return docs.select(*text).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT * (n + SMOOTHING) / (total + SMOOTHING * terms))``, exactly."""
    above = (n + SMOOTHING).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + (terms * SMOOTHING).cast("decimal(18,0)")
    return F.call_function("div", above, below) + 1


def block_distances(cells: pd.DataFrame, zero: np.ndarray, terms: int) -> np.ndarray:
    """Half-sums ``A`` of one block: ``A + A.T`` holds the distances of all groups.

    ``cells`` has ``g, term, p``: a group's number, a term and its share; ``zero`` the
    baseline of each group; ``terms`` the number of the block's terms.
    """
    many = len(zero)
    cells = cells.sort_values(["g", "p"], kind="stable")
    g, p = cells["g"].to_numpy(np.int64), cells["p"].to_numpy(np.int64)
    t = np.unique(cells["term"].to_numpy(), return_inverse=True)[1].reshape(-1)
    rows = np.searchsorted(g, np.arange(many + 1))  # by group, each group's shares in order
    held = np.diff(rows)
    order = np.lexsort((g, t))  # by term, and by group within
    peer, peer_p = g[order], p[order]
    cols = np.searchsorted(t[order], np.arange(t.max() + 2 if len(t) else 1))
    out = np.zeros((many, many), np.int64)
    for i in range(many):
        a, b = rows[i], rows[i + 1]
        mine = p[a:b]
        # this group's terms against the other's baseline, as if the other lacked them all
        sums = np.concatenate([[0], np.cumsum(mine)])
        under = np.searchsorted(mine, zero)
        acc = zero * under - sums[under] + (sums[-1] - sums[under]) - zero * (len(mine) - under)
        gap = np.abs(zero - zero[i])
        later = np.arange(many) > i  # each pair's common part in one of its two rows
        acc += np.where(later, (terms - held[i] - held) * gap, 0)
        for s in range(a, b, max(1, _SCATTER // many)):
            part = slice(s, min(b, s + max(1, _SCATTER // many)))
            first, end = cols[t[part]], cols[t[part] + 1]
            size = end - first
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
            own, who, other = np.repeat(p[part], size), peer[at], peer_p[at]
            use = who > i
            own, who, other = own[use], who[use], other[use]
            both = np.abs(own - other) - np.abs(own - zero[who]) - np.abs(other - zero[i]) + gap[who]
            acc += np.bincount(who, both, minlength=many).astype(np.int64)
        out[i] = acc
        out[i, i] = 0
    return out


def distances(cells: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, g, h, value)`` of all ordered pairs of a language's groups."""
    sizes = cut(cells.groupBy("lang").agg(F.count("*").alias("cells")).withColumn(
        "blocks", F.ceil(F.col("cells") / BLOCK_CELLS).cast("int")))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    terms = join_groups(kept, sizes, ["lang"], "cells").select("lang", block).groupBy("lang", "block").agg(
        F.count("*").alias("terms"))
    # every block gets its language's groups with their baselines
    frame = terms.join(groups.select("lang", "g", "zero"), "lang").select(
        F.col("lang").alias("of_lang"), F.col("block").alias("of_block"), "g", "zero", "terms")
    inside = join_groups(cells, sizes, ["lang"], "cells").select("lang", block, "g", "term", "p")

    def add_up(key: tuple, cells: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("g")
        if not len(frame):
            return pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})
        half = block_distances(cells, frame["zero"].to_numpy(np.int64), int(frame["terms"].iloc[0]))
        whole = half + half.T
        a, b = np.triu_indices(len(whole), 1)
        return pd.DataFrame({"lang": key[0], "a": a, "b": b, "value": whole[a, b]})

    part = inside.groupBy("lang", "block").cogroup(frame.groupBy("of_lang", "of_block")).applyInPandas(
        add_up, "lang string, a long, b long, value long")
    total = stored(part.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    return (total.select("lang", F.col("a").alias("g"), F.col("b").alias("h"), "value")
            .unionByName(total.select("lang", F.col("b").alias("g"), F.col("a").alias("h"), "value")))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: sources by distance, and each group's own terms."""
    # dealt by (lang, term), so that a term's rows of all groups meet without a further shuffle
    every = counts(docs, text_col, lang_col, source_col).repartition("lang", "term") \
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    every = every.withColumn("lang_n", F.sum("n").over(term)).withColumn("lang_docs", F.sum("docs").over(term))
    every = stored(every.where((F.col("lang_docs") >= min_docs) | (F.col("term") == "")).drop("docs", "lang_docs"))
    cells = every.where("term <> ''")
    kept = cells.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("cells"))
    groups = every.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "cells", "terms")], "lang_total")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0)
    groups = cut(groups.withColumn("g", number.cast("long")).withColumn("zero", zero))
    shares = join_groups(cells, groups, ["lang", "source"], "cells").select(
        "lang", "source", "g", "term", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    shares = stored(shares)

    here, there = (groups.select("lang", F.col("g").alias(k), F.col("source").alias(name))
                   for k, name in (("g", "source"), ("h", "item")))
    pairs = distances(shares, groups, shares.select("lang", "term").distinct()) \
        .join(here, ["lang", "g"]).join(there, ["lang", "h"]).select("lang", "source", "item", "value")
    # languages without a term have no block; their pairs are dealt by salt
    bare = groups.where("terms = 0")
    salted = [bare.select("lang", "source", F.pmod("g", F.lit(_SALTS)).alias("salt")),
              bare.select("lang", F.col("source").alias("item"),
                          F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))]
    pairs = pairs.unionByName(salted[0].join(salted[1], ["lang", "salt"]).where("source <> item")
                              .select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    # rows are cut to the top terms before they are shuffled
    terms = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = pairs.withColumn("rank", rank)
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= top_terms)
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", F.col("value").cast("long"), "rank")
