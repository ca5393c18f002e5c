"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MULT = np.uint64(0x9E3779B97F4A7C15)


def let_workers_import(spark: SparkSession) -> None:
    """Puts this library's folder on the Python workers' path, wherever the driver was started.

    On a cluster without that folder this does nothing; the package is shipped as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; read by Spark alone, so any store will do."""
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a scratch folder; a cluster session
    without it is an error.
    """
    let_workers_import(spark)
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: ends the lineage with files that all executors share."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a compressed table in the shared folder, for rows that are many."""
    path = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Steps that are written within leave no shuffle files behind; else these stay until the driver collects garbage.

    For steps that are executed once. The session's own setting holds again afterwards.
    """
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


#: Groups that hold this share (1 / HOT_GROUPS) of all rows are broadcast; there are no more than that many.
HOT_GROUPS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Inner join of rows to ``groups`` (one row for each key, with the number of its rows in ``size``).

    A group that holds a thousandth of all rows or more is joined where its rows are, by a
    broadcast of a thousand groups at most, so a hot group is never one task's work. Both
    sides are read twice: pass written tables. Rows with a null in a key join nothing.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT_GROUPS >= total
    few = F.broadcast(groups.where(hot))
    return rows.join(few, keys).unionByName(
        rows.join(few.select(*keys), keys, "left_anti").join(groups.where(~hot), keys))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_WEIGHTS = np.random.default_rng(2024).integers(0, 1 << 63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word between ASCII white space, with A-Z lower-cased (null: none).

    A word's bytes are weighted by their places in it and summed, for all words at once.
    """
    if not text:
        return np.empty(0, np.uint64)
    data = np.frombuffer(text.encode().lower(), np.uint8)
    space = np.concatenate([[True], _IS_SPACE[data], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    first, size = edges[::2], edges[1::2] - edges[::2]
    if not len(first):
        return np.empty(0, np.uint64)
    inside = np.flatnonzero(~space[1:-1])
    begin = np.cumsum(size) - size  # of each word among the bytes of all words
    place = np.arange(len(inside)) - np.repeat(begin, size)
    weight = _WEIGHTS[place & 4095] + (place >> 12).astype(np.uint64) * _MULT
    return mix(np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * weight, begin)
               + size.astype(np.uint64) * _MULT)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (spreads every input bit over the word)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; fewer words give none."""
    n = len(word_hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = (out + word_hashes[i:i + n]) * _MULT
        out ^= out >> np.uint64(29)
    return mix(out)


class BitTable:
    """Set of 64-bit hashes, held as bits of a table of fixed size.

    Spark sums the bits up, so the driver gets ``2 ** (bits - 6)`` numbers at most,
    however many hashes there are. A test may say yes to a hash that isn't in the set,
    never no to one that is: it thins rows out before an exact join.
    """

    def __init__(self, hashes: DataFrame, column: str, bits: int) -> None:
        slot = F.shiftrightunsigned(column, 64 - bits)
        bit = F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))"))
        found = hashes.groupBy(F.shiftright(slot, 6).alias("at")).agg(bit.alias("bits")).toArrow()
        words = np.zeros(1 << (bits - 6), np.int64)
        words[found["at"].to_numpy()] = found["bits"].to_numpy()
        self.shift = np.uint64(64 - bits)
        self.shared = hashes.sparkSession.sparkContext.broadcast(words.view(np.uint64))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> self.shift
        return (self.shared.value[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0
