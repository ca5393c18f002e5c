"""Benchmark decontamination (operator 6): rare n-gram seeds, then Smith-Waterman.

Runs of ``SEED_WORDS`` words of the benchmark items are looked up in every document. A
bit table of fixed size holds the items' n-grams, so one pass over the texts returns the
few places that may match, each with the words around it. Those places are joined to the
items by n-gram. Seeds are the n-grams that few documents hold, and always the rarer
half of an item's own, so an item that has leaked into very many documents keeps its
seeds. Around the seeds, local alignment of words scores exact, paraphrased and edited
copies: a match counts 1, a differing, missing or added word -1. A document is reported
for an item if the best score is at least ``MIN_SCORE`` of the item's words.

An item of fewer than ``MIN_ITEM_WORDS`` words is found where all of it stands, word for
word. One of fewer than ``SEED_WORDS`` words is its own seed, and evidence only if it is
rare among the documents (``RARE_SHARE``, or in one document).

Defined cases: a null or empty text and an item without words match nothing; items with
repeated ids are aligned one by one and the best counts; repeated documents are reported
once per (id, item); rows with null ids take no part; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerframe.llm.common import BitTable, cut, shingles, word_hashes

SEED_WORDS = 4
MIN_ITEM_WORDS = 8
RARE_SHARE = 0.001
MIN_SCORE = 0.5
#: log2 of the bits in the look-up table: 2 MB, whatever the benchmark's size.
TABLE_BITS = 24
_CELLS = 1 << 21


def item_grams(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item, part, words, grams)``: hashed words and seed n-grams of each item that has words."""
    id_type = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [word_hashes(t) for t in batch["t"]]
            grams = [shingles(w, max(1, min(SEED_WORDS, len(w)))).view(np.int64) for w in words]
            yield pd.DataFrame({"item": batch["i"], "words": [w.view(np.int64) for w in words], "grams": grams})

    found = (items.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).distinct()
             .mapInPandas(run, f"item {id_type}, words array<long>, grams array<long>"))
    return (found.where(F.size("words") > 0)
            .withColumn("part", F.xxhash64("item", "words")))


def _places(docs: DataFrame, id_col: str, text_col: str, table: BitTable, around: int,
            lengths: list[int]) -> DataFrame:
    """Stretches of documents around n-grams that may be an item's.

    ``doc, base, words, grams, at``: hashed words from word ``base`` on, and the n-grams
    in question with their places in the document. ``lengths`` are the n-grams' lengths.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc {id_type}, base int, words array<long>, grams array<long>, at array<int>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text in zip(batch["i"], batch["t"]):
                words = word_hashes(text)
                every = [shingles(words, n) for n in lengths]
                at = [np.flatnonzero(table.has(grams)) for grams in every]
                hit = np.concatenate(at)
                if not len(hit):
                    continue
                grams = np.concatenate([g[x] for g, x in zip(every, at)])
                order = np.argsort(hit, kind="stable")
                hit, grams = hit[order], grams[order]
                for some in np.split(np.arange(len(hit)), np.flatnonzero(np.diff(hit) > around) + 1):
                    run_ = hit[some]
                    base = max(0, int(run_[0]) - around)
                    stretch = words[base:int(run_[-1]) + SEED_WORDS + around]
                    out.append((doc, base, stretch.view(np.int64), grams[some].view(np.int64), run_.astype(np.int32)))
            yield pd.DataFrame(out, columns=["doc", "base", "words", "grams", "at"])

    return docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInPandas(run, schema)


def align(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each a[k] in b[k], and where in b[k] it ends.

    All pairs advance together, one word of a at a time; gaps along b are a running
    maximum.
    """
    n, m = max(map(len, a)), max(map(len, b))
    rows = len(a)
    x, y = np.zeros((rows, n), np.uint64), np.zeros((rows, m), np.uint64)
    x_ok, y_ok = np.zeros((rows, n), bool), np.zeros((rows, m), bool)
    for k in range(rows):
        x[k, :len(a[k])], y[k, :len(b[k])] = a[k], b[k]
        x_ok[k, :len(a[k])], y_ok[k, :len(b[k])] = True, True
    steps = np.arange(m + 1, dtype=np.int32)
    score = np.zeros((rows, m + 1), np.int32)
    best, end = np.zeros(rows, np.int32), np.zeros(rows, np.int32)
    for i in range(n):
        same = (x[:, i, None] == y) & y_ok & x_ok[:, i, None]
        now = np.zeros_like(score)
        now[:, 1:] = np.maximum(score[:, :-1] + np.where(same, 1, -1), score[:, 1:] - 1)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + steps, axis=1) - steps
        here = now.argmax(axis=1)
        top = now[np.arange(rows), here]
        better = top > best
        best[better], end[better] = top[better], here[better]
        score = now
    return best, end


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE,
          rare_share: float = RARE_SHARE) -> DataFrame:
    """``(id_col, item_id_col, score, aligned, item_words, end_word)``, one row per document and item found.

    ``aligned`` is the alignment score in words, ``score`` its share of the item's words,
    and ``end_word`` the word of the document at which the best alignment ends.
    """
    grams = cut(item_grams(items, item_id_col, item_text_col))
    n_words = F.size("words")
    longest, lengths = grams.agg(F.max(n_words), F.collect_set(F.least(n_words, F.lit(SEED_WORDS)))).first()
    around = int((longest or 0) * 1.25) + 1
    table = BitTable(grams.select(F.explode("grams").alias("gram")), "gram", TABLE_BITS)
    places = cut(_places(docs, id_col, text_col, table, around, sorted(lengths) or [SEED_WORDS]))
    places = places.withColumn("place", F.xxhash64("doc", "base", "words"))
    seen = places.select("doc", "place", F.explode(F.arrays_zip("grams", "at")).alias("x")) \
        .select("doc", "place", F.col("x.grams").alias("gram"), F.col("x.at").alias("at"))
    # how many documents hold each n-gram, over all documents
    held = seen.groupBy("gram").agg(F.count_distinct("doc").alias("held"))
    most = F.lit(rare_share) * docs.agg(F.count("*")).scalar()
    short = (n_words < SEED_WORDS).alias("short")
    of_item = grams.select("item", "part", short, F.posexplode("grams").alias("pos", "gram")) \
        .join(held, "gram")
    middle = of_item.groupBy("item", "part").agg(F.percentile("held", F.lit(0.5)).alias("middle"))
    seeds = (of_item.join(middle, ["item", "part"])
             .where(F.when(F.col("short"), F.col("held") <= F.greatest(most, F.lit(1.0)))
                    .otherwise((F.col("held") <= most) | (F.col("held") <= F.col("middle"))))
             .select("gram", "item", "part", "pos"))
    start = (F.col("at") - F.col("pos")).alias("start")
    pairs = (seen.join(seeds, "gram").select("doc", "place", "item", "part", start)
             .groupBy("doc", "place", "item", "part").agg(F.collect_set("start").alias("starts")))
    pairs = (pairs.join(places.select("doc", "place", "base", F.col("words").alias("stretch"))
                        .dropDuplicates(["doc", "place"]), ["doc", "place"])
             .join(grams.select("item", "part", "words"), ["item", "part"]))
    doc_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, a, b, first = [], [], [], []
            for k, (words, stretch, base, starts) in enumerate(
                    zip(batch["words"], batch["stretch"], batch["base"], batch["starts"])):
                words = np.asarray(words, np.int64).view(np.uint64)
                stretch = np.asarray(stretch, np.int64).view(np.uint64)
                slack = len(words) // 4 + 1
                at = np.sort(np.asarray(starts, np.int64) - base)
                for run_ in np.split(at, np.flatnonzero(np.diff(at) > 2 * slack) + 1):
                    lo = max(0, int(run_[0]) - slack)
                    rows.append(k)
                    a.append(words)
                    b.append(stretch[lo:int(run_[-1]) + len(words) + slack])
                    first.append(base + lo)
            if not rows:
                continue
            best, end = np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int32)
            order = np.argsort([len(x) for x in b], kind="stable")
            at = 0
            while at < len(order):  # blocks of pairs of like length, bounded in cells
                size = 1
                while at + size < len(order) and (size + 1) * len(b[order[at + size]]) * 4 < _CELLS:
                    size += 1
                some = order[at:at + size]
                best[some], end[some] = align([a[i] for i in some], [b[i] for i in some])
                at += size
            length = np.array([len(x) for x in a])
            ok = np.flatnonzero(best >= np.where(length < MIN_ITEM_WORDS, length, min_score * length))
            of = np.array(rows)[ok]
            yield pd.DataFrame({
                "doc": batch["doc"].to_numpy()[of], "item": batch["item"].to_numpy()[of],
                "score": best[ok] / length[ok], "aligned": best[ok], "item_words": length[ok],
                "end_word": np.array(first)[ok] + end[ok]})

    found = pairs.select("doc", "item", "base", "starts", "stretch", "words").mapInPandas(
        run, f"doc {doc_type}, item {item_type}, score double, aligned int, item_words int, end_word int")
    best = found.groupBy("doc", "item").agg(F.max(F.struct(
        "score", "aligned", "item_words", (-F.col("end_word")).alias("end"))).alias("x"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_id_col), "x.score", "x.aligned",
                       "x.item_words", (-F.col("x.end")).alias("end_word"))


def remove_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those that hold a benchmark item."""
    gone = leaks(docs, items, id_col, text_col).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
