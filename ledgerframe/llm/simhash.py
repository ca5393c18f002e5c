"""SimHash near-dedup by tiled exact comparison (operator 8).

Fingerprints are compared exactly, tile against tile, with numpy exclusive-or and bit
counts. A tile holds the distinct fingerprints whose four 16-bit quarters have the same
population counts. Two fingerprints at Hamming distance d have quarter counts that
differ by at most d in total, so only tile pairs within the radius are compared; the
others are never formed. Equal fingerprints are folded first, so a group of copies is
one entry. Each tile pair returns a spanning forest of its links, which keeps every
connection without listing the pairs of a dense group.

Defined cases: a null or empty text has fingerprint 0 and is linked like any other;
repeated rows are separate rows of one class; rows with a null id keep their fingerprint
and take no part in the choice of the smallest id; an empty table gives an empty result;
other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerframe.llm.common import cut
from ledgerframe.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
#: Fingerprints a tile block holds at most on average; larger tiles are dealt into blocks.
TILE_ROWS = 4096
_CELLS = 1 << 20
_SIDE = 17  # a 16-bit quarter has 0 to 16 bits set


def simhash(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= words_per_shingle:
        hashes = [digest(b" ".join(words), 42)]
    else:
        line = b" ".join(words)
        width = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(width + 1) - 1
        first, last = (end - width)[:len(words) - words_per_shingle + 1], end[words_per_shingle - 1:]
        hashes = [digest(line[a:b], 42) for a, b in zip(first.tolist(), last.tolist())]
    rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(rows), 65536):
        ones += np.unpackbits(rows[i:i + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(rows), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(id_col, fp)``: one row per input row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"i": batch["i"], "fp": np.array(
                [simhash(t, words_per_shingle) for t in batch["t"]], np.int64)})

    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInPandas(run, f"i {id_type}, fp long").withColumnRenamed("i", id_col))


def _tile_of(fp: Column) -> Column:
    quarters = [F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(4)]
    key = F.lit(0)
    for q in quarters:
        key = key * _SIDE + q
    return key.cast("int")


def _offsets(radius: int) -> list[list[int]]:
    """Steps from a tile to itself and to those after it within the radius."""
    steps = product(range(-radius, radius + 1), repeat=4)
    return [list(s) for s in steps if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]


def _forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[list[int], list[int]]:
    """Rows of a and b of a spanning forest of the links between two blocks."""
    label = np.arange(len(b))  # classes of b's rows so far, when linked through rows of a
    left, right = [], []
    step = max(1, _CELLS // max(1, len(b)))
    for at in range(0, len(a), step):
        near = np.bitwise_count(a[at:at + step, None] ^ b[None, :]) <= radius
        if same:  # each pair once
            near &= np.arange(len(b)) > np.arange(at, at + len(near))[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            hit = np.flatnonzero(near[i])
            classes, where = np.unique(label[hit], return_index=True)
            left += [at + int(i)] * len(classes)
            right += hit[where].tolist()
            if len(classes) > 1:
                label[np.isin(label, classes)] = classes[0]
    return left, right


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: links that join the same components as all pairs within ``max_bits``.

    ``fps`` holds distinct fingerprints in a column ``fp``.
    """
    tiled = fps.select("fp", _tile_of(F.col("fp")).alias("tile"))
    # at most 17**4 tiles, whatever the number of documents
    counts = tiled.groupBy("tile").agg(F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("parts"))
    blocks = (tiled.join(F.broadcast(counts), "tile")
              .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
              .groupBy("tile", "part").agg(F.sort_array(F.collect_list("fp")).alias("fps")))
    blocks = cut(blocks)
    q = [F.floor(F.col("tile") / _SIDE ** (3 - k)).cast("int") % _SIDE for k in range(4)]
    step = F.explode(F.array(*[F.array(*map(F.lit, s)) for s in _offsets(max_bits)]))
    left = (blocks.select("tile", "part", "fps", step.alias("step"))
            .select("tile", "part", "fps", *[(q[k] + F.col("step")[k]).alias(f"n{k}") for k in range(4)]))
    inside = F.lit(True)
    key = F.lit(0)
    for k in range(4):
        inside = inside & F.col(f"n{k}").between(0, _SIDE - 1)
        key = key * _SIDE + F.col(f"n{k}")
    left = left.where(inside).select(F.col("tile").alias("ta"), F.col("part").alias("pa"),
                                     F.col("fps").alias("fa"), key.cast("int").alias("near"))
    pairs = left.join(blocks.select(F.col("tile").alias("near"), F.col("part").alias("pb"),
                                    F.col("fps").alias("fb")), "near")
    pairs = pairs.where((F.col("ta") != F.col("near")) | (F.col("pa") <= F.col("pb"))) \
        .where((F.col("ta") != F.col("near")) | (F.col("pa") != F.col("pb")) | (F.size("fa") > 1)) \
        .select("fa", "fb", ((F.col("ta") == F.col("near")) & (F.col("pa") == F.col("pb"))).alias("same"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out_a, out_b = [], []
            for fa, fb, same in zip(batch["fa"], batch["fb"], batch["same"]):
                a, b = np.asarray(fa, np.int64), np.asarray(fb, np.int64)
                i, j = _forest(a.view(np.uint64), b.view(np.uint64), max_bits, same)
                out_a.append(a[i])
                out_b.append(b[j])
            if out_a:
                yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return pairs.mapInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(id_col, fp, component_id)``: component_id is the smallest id reachable over links."""
    of_doc = cut(fingerprints(docs, id_col, text_col, words_per_shingle))
    distinct = cut(of_doc.groupBy("fp").agg(F.min(id_col).alias("first")))
    linked = connected_components(links(distinct, max_bits), "a", "b")
    linked = cut(linked.join(distinct, F.col("node") == F.col("fp")).select("fp", "root", "first"))
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    of_linked = linked.join(least, "root").select("fp", "least")
    classes = (distinct.join(of_linked, "fp", "left")
               .select("fp", F.coalesce("least", "first").alias("component_id")))
    # a written table, so that the join is one of two plain sides and Spark can split a hot fingerprint
    return of_doc.join(cut(classes), "fp").select(id_col, "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents without those of which a group member with a smaller id stays.

    Rows with a null id are kept, as nothing tells them apart.
    """
    found = near_duplicates(docs.where(F.col(id_col).isNotNull()), id_col, text_col,
                            words_per_shingle, max_bits)
    gone = found.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("_gone"))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
