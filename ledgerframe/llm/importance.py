"""Target-distribution importance resampling by batch concatenation (operator 12).

Documents are drawn so that their hashed words and word pairs resemble a target's. Two
passes over the texts, one for the counts and one for the scores, share one way to find
features: the texts of a batch are joined with a separator that stands in no word, one
regular expression runs over the whole, ``searchsorted`` in the texts' offsets tells which
text a word is of, pairs that cross a border are masked, and ``bincount`` adds up. Words
are taken from the expression in blocks, so a text of any length needs no more than
itself and one block.

A bucket's gain is the log ratio of its smoothed shares in target and corpus, in
thousandths, rounded down; a document's weight is the mean gain of its features, rounded
down. Gumbel noise from a hash of the id makes the highest scores a draw without
replacement in proportion to the exponentiated weights. Scores are whole numbers, so ranks
come from counts by score; only the rows of one score are sorted together.

Defined cases: a null or empty text has no features and weight 0; a null id counts as the
empty string in the noise and stands last among ties; repeated rows are drawn each for itself, with equal
scores; an empty table gives an empty result, an empty target equal shares; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerframe.llm.common import cut, stored

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Texts are joined until they hold this many bytes; words are taken in blocks of this many.
_JOINED, _BLOCK = 1 << 22, 1 << 17
_SEPARATOR = b"\x00"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: all but ASCII punctuation, space, controls


def joined(texts: pd.Series) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """``(first, end, bytes, offsets)``: runs of texts lower-cased and joined, and where each begins."""
    first, parts, held = 0, [], 0
    for k, text in enumerate(texts):
        parts.append(text.encode().lower() if text else b"")  # bytes: A-Z alone
        held += len(parts[-1]) + 1
        if held >= _JOINED or k + 1 == len(texts):
            size = np.array([len(p) + 1 for p in parts], np.int64)
            yield first, k + 1, _SEPARATOR.join(parts), np.cumsum(size) - size
            first, parts, held = k + 1, [], 0


def features(data: bytes, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of ``(owner, bucket, pair_owner, pair_bucket)`` of the words and word pairs of joined texts."""
    found = _WORD.finditer(data)
    last_owner, last_crc = -1, 0
    while block := list(islice(found, _BLOCK)):
        words = [m.group() for m in block]
        starts = np.fromiter((m.start() for m in block), np.int64, len(block))
        owner = np.searchsorted(offsets, starts, side="right") - 1
        crc = [crc32(w) for w in words]
        before = [last_crc, *crc[:-1]]
        pair = np.array([crc32(w, crc32(b" ", c)) for w, c in zip(words, before)], np.int64)
        within = owner == np.concatenate([[last_owner], owner[:-1]])
        yield owner, np.array(crc, np.int64) % BUCKETS, owner[within], pair[within] % BUCKETS
        last_owner, last_crc = owner[-1], crc[-1]


def bucket_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """Number of features in each bucket over all texts. A task returns its non-zero buckets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, data, offsets in joined(batch["t"]):
                for _, one, _, two in features(data, offsets):
                    total += np.bincount(one, minlength=BUCKETS) + np.bincount(two, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    rows = (docs.select(F.col(text_col).alias("t")).where(F.col("t").isNotNull())
            .mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(BUCKETS, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's smoothed shares, in thousandths, rounded down."""
    big_s, big_t = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1.0) * big_s / ((s + 1.0) * big_t)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of an id, in thousandths, rounded down."""
    name = "" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, seed: int) -> DataFrame:
    """``(d, n_words, n_features, weight, score)`` of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gain = shared.value
        for batch in batches:
            words, pairs, total = (np.zeros(len(batch), np.int64) for _ in range(3))
            for first, end, data, offsets in joined(batch["t"]):
                n = end - first
                for owner, one, pair_owner, two in features(data, offsets):
                    words[first:end] += np.bincount(owner, minlength=n)
                    pairs[first:end] += np.bincount(pair_owner, minlength=n)
                    for who, where in ((owner, one), (pair_owner, two)):  # whole numbers below 2 ** 53: exact
                        total[first:end] += np.bincount(who, gain[where], minlength=n).astype(np.int64)
            count = words + pairs
            weight = total // np.maximum(count, 1)
            ids = [None if pd.isna(d) else int(d) for d in batch["d"]]
            yield pd.DataFrame({"d": pd.array(ids, "Int64"), "n_words": words, "n_features": count, "weight": weight,
                                "score": weight + np.array([noise(d, seed) for d in ids], np.int64)})

    return (docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))
            .mapInPandas(run, f"d {id_type}, n_words long, n_features long, weight long, score long"))


def drawn(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... of the highest scores among rows with enough words, else null.

    Counts by score are as many rows as there are scores, whole numbers between about
    -50,000 and 70,000, whatever the number of documents; they alone meet in one window and
    are broadcast.
    """
    fit = F.col("n_words") >= min_words
    by_score = scored.where(fit).groupBy("score").agg(F.count("*").alias("c"))
    above = F.sum("c").over(Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1))
    by_score = cut(by_score.withColumn("above", F.coalesce(above, F.lit(0))))
    many = (by_score.agg(F.sum("c")).first()[0] or 0) * percent // 100
    some = by_score.where(F.col("above") < many).select("score", "above")
    place = F.row_number().over(Window.partitionBy("score").orderBy(
        F.col("d").asc_nulls_last(), "n_features", "weight"))
    high = (scored.where(fit).join(F.broadcast(some), "score")
            .withColumn("rank", (F.col("above") + place).cast("long"))
            .withColumn("rank", F.when(F.col("rank") <= many, F.col("rank"))).drop("above"))
    low = scored.where(~fit).unionByName(scored.where(fit).join(F.broadcast(some), "score", "left_anti"))
    return high.unionByName(low.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED) -> DataFrame:
    """``id_col, n_features, weight, score, rank``, one row per document; the drawn ones have a rank."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    scored = stored(scores(docs, gain, id_col, text_col, seed))
    return drawn(scored, percent, min_words).select(F.col("d").alias(id_col), "n_features", "weight", "score", "rank")
