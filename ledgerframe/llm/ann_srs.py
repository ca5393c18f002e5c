"""Approximate nearest neighbours by stable projections (operator 1).

Vectors are projected to ``DIMS`` dimensions with a Gaussian (2-stable) matrix, so that
the squared projected distance over the squared true distance follows a chi-square law
with ``DIMS`` degrees of freedom. A kd-tree over the projections, fitted on a bounded
sample, deals every vector to a cell; a cell is a Spark group. A query reads its
neighbours in order of projected distance and verifies them with exact inner products
until the chi-square test holds: a vector as near as the current k-th one would have
shown up by now with probability ``CONFIDENCE``.

The search runs in two passes. The first visits the ``FIRST_CELLS`` cells nearest to the
query and yields a bound on the k-th distance. The second visits all other cells that the
test cannot yet exclude, with that bound. Within a cell, verification is incremental.

Largest inner product becomes nearest distance by one more coordinate, which brings all
vectors to the length of the longest. Equal vectors are folded to one index entry that
keeps its k + 1 smallest ids, which is all that k results without the query itself need;
so a vector with very many copies fills no cell.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
take no part, nor do rows with null ids, or with a length other than the most common one;
rows that repeat id and vector are one row; with fewer than k other vectors all are
returned; ties go to the smaller id; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerframe.llm.common import cut

K = 20
DIMS = 8  # even, for the closed form of the chi-square law
CONFIDENCE = 0.97
FIRST_CELLS = 3
#: Rows that the tree is fitted on, and cells it has, at most; index rows and queries that
#: meet in one group, on average at most.
SAMPLE_ROWS = 20_000
MAX_CELLS = 1024
CELL_ROWS = 2048
QUERY_ROWS = 1024
_VERIFY = 256


def chi_square(x: float, dims: int = DIMS) -> float:
    """Cumulative chi-square law, for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(dims // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def chi_square_limit(confidence: float, dims: int = DIMS) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < confidence else (low, mid)
    return high


@dataclass
class Tree:
    """kd-tree: inner nodes split at a median; leaves are numbered, with a bounding box each."""

    axis: list[int]
    at: list[float]
    child: list[tuple[int, int]]  # node numbers; leaves are ~number
    low: np.ndarray
    high: np.ndarray

    def cells(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        todo = [(0 if self.axis else ~0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = ~node
                continue
            right = points[rows, self.axis[node]] > self.at[node]
            todo += [(self.child[node][0], rows[~right]), (self.child[node][1], rows[right])]
        return out

    def gaps(self, point: np.ndarray) -> np.ndarray:
        """Squared distance from a point to each leaf's part of space."""
        away = np.maximum(0, np.maximum(self.low - point, point - self.high))
        return (away * away).sum(axis=1)


def build_tree(points: np.ndarray, leaves: int) -> Tree:
    """Splits the widest axis at the median until there are about ``leaves`` leaves."""
    dims = points.shape[1]
    tree = Tree([], [], [], np.empty((0, dims)), np.empty((0, dims)))
    lows, highs = [], []

    def grow(rows: np.ndarray, parts: int, low: np.ndarray, high: np.ndarray) -> int:
        some = points[rows]
        spread = some.max(axis=0) - some.min(axis=0) if len(some) else np.zeros(dims)
        axis = int(spread.argmax())
        if parts < 2 or len(some) < 2 or spread[axis] == 0:
            lows.append(low)
            highs.append(high)
            return ~(len(lows) - 1)
        cut_at = float(np.partition(some[:, axis], (len(some) - 1) // 2)[(len(some) - 1) // 2])
        right = some[:, axis] > cut_at
        node = len(tree.axis)
        tree.axis.append(axis)
        tree.at.append(cut_at)
        tree.child.append((0, 0))
        up, down = high.copy(), low.copy()
        up[axis] = down[axis] = cut_at
        tree.child[node] = (grow(rows[~right], parts // 2, low, up),
                            grow(rows[right], parts - parts // 2, down, high))
        return node

    grow(np.arange(len(points)), leaves, np.full(dims, -np.inf), np.full(dims, np.inf))
    tree.low, tree.high = np.array(lows), np.array(highs)
    return tree


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)`` of the rows that take part, as doubles."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col(id_col).alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull())
            .where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)))
    return rows.distinct()


def neighbours(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
               k: int = K, seed: int = 1) -> DataFrame:
    """``(query_id, rank, id_col, score)``: the k rows of ``vectors`` found for each row of ``queries``.

    A row with the query's own id is no neighbour of it.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    empty = vectors.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, {id_col} {id_type}, score double")
    rows = cut(usable(vectors, id_col, vec_col))
    common = (rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
              .orderBy(F.col("rows").desc(), "n").first())
    if common is None:
        return empty
    width = common["n"]
    rows = rows.where(F.size("v") == width)
    asked = usable(queries, id_col, vec_col).where(F.size("v") == width)

    # equal vectors: one entry with the smallest ids
    smallest = Window.partitionBy("v").orderBy("id")
    entries = (rows.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
               .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    entries = cut(entries)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    total, longest = entries.agg(F.count("*"), F.max(square)).first()
    matrix = np.random.default_rng(seed).standard_normal((width + 1, DIMS))

    def project(v: np.ndarray, lifted: bool) -> np.ndarray:
        out = v @ matrix[:width]
        if lifted:
            out += np.sqrt(np.maximum(0, longest - (v * v).sum(axis=1)))[:, None] * matrix[width]
        return out

    share = min(1.0, SAMPLE_ROWS / total)
    sample = entries.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) / (1 << 30) < share).select("v").toPandas()
    points = project(np.stack(sample["v"]), True) if len(sample) else np.zeros((0, DIMS))
    tree = build_tree(points, min(MAX_CELLS, -(-total // CELL_ROWS)))
    limit = chi_square_limit(CONFIDENCE)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["cell"] = tree.cells(project(np.stack(batch["v"]), True))
                yield batch

    index = cut(entries.mapInPandas(deal, f"v array<double>, ids array<{id_type}>, cell int"))
    # cells that hold more than their share, as the data have it, are dealt into parts
    parts = (index.groupBy("cell").agg(F.ceil(F.count("*") / (2 * CELL_ROWS)).cast("int").alias("parts")))
    index = (index.join(F.broadcast(parts), "cell")  # at most MAX_CELLS rows
             .withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
             .select("cell", "part", "v", "ids"))

    def probe(visits: DataFrame) -> DataFrame:
        """``(query_id, ids, scores)``: the best of each visited cell part that beat the bound."""
        blocks = (visits.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks")))
        visits = (visits.join(F.broadcast(blocks), "cell")  # at most MAX_CELLS rows
                  .join(F.broadcast(parts), "cell")
                  .withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
                  .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                  .select("cell", "part", "block", "query_id", "q", "bound"))
        held = (index.join(F.broadcast(blocks), "cell")
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .select("cell", "part", "block", "v", "ids"))

        def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(left) and len(right):
                v = np.stack(right["v"])
                place, ids = project(v, True), right["ids"].tolist()
                q = np.stack(left["q"])
                for query, vector, where, bound in zip(left["query_id"], q, project(q, False), left["bound"]):
                    out.append((query, *_search_cell(vector, where, bound, query, v, place, ids)))
            return pd.DataFrame([r for r in out if len(r[1])], columns=["query_id", "ids", "scores"])

        def _search_cell(vector, where, bound, query, v, place, ids):
            reach = longest + vector @ vector  # squared distance = reach - 2 * inner product
            gap = ((place - where) ** 2).sum(axis=1)
            order = np.argsort(gap, kind="stable")
            best: list[tuple[float, object]] = []
            floor = bound
            for at in range(0, len(order), _VERIFY):
                if gap[order[at]] > limit * max(0.0, reach - 2 * floor):
                    break  # the chi-square test holds
                some = order[at:at + _VERIFY]
                score = (v[some] * vector).sum(axis=1)
                for row in np.flatnonzero(score >= floor):
                    best += [(-score[row], i) for i in ids[some[row]] if i != query]
                if len(best) > k:
                    best = sorted(best)[:k]
                if len(best) == k:
                    floor = max(floor, -best[-1][0])
            best.sort()
            return [i for _, i in best[:k]], [-s for s, _ in best[:k]]

        return (visits.groupBy("cell", "part", "block")
                .cogroup(held.groupBy("cell", "part", "block"))
                .applyInPandas(search, f"query_id {id_type}, ids array<{id_type}>, scores array<double>"))

    def ranked(found: DataFrame) -> DataFrame:
        nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
        return (found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
                .select("query_id", F.col("x.ids").alias("id"), F.col("x.scores").alias("score"))
                .withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k))

    asked = asked.select(F.col("id").alias("query_id"), F.col("v").alias("q"))

    def nearest_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                order = [np.argsort(tree.gaps(p), kind="stable")[:FIRST_CELLS]
                         for p in project(np.stack(batch["q"]), False)]
                yield pd.DataFrame({"query_id": batch["query_id"], "q": batch["q"], "bound": -np.inf, "cell": order})

    def other_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                q, rest = np.stack(batch["q"]), []
                for vector, place, bound in zip(q, project(q, False), batch["bound"]):
                    gaps = tree.gaps(place)
                    near = np.argsort(gaps, kind="stable")[FIRST_CELLS:]
                    far = limit * max(0.0, longest + vector @ vector - 2 * bound) if np.isfinite(bound) else np.inf
                    rest.append(near[gaps[near] <= far])
                yield batch[["query_id", "q", "bound"]].assign(cell=rest)

    visited = f"query_id {id_type}, q array<double>, bound double, cell array<int>"
    each = F.explode("cell").alias("cell")
    first = cut(probe(asked.mapInPandas(nearest_cells, visited).select("query_id", "q", "bound", each)))
    bound = ranked(first).where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    second = (asked.join(bound, "query_id", "left")
              .withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
              .mapInPandas(other_cells, visited).select("query_id", "q", "bound", each))
    return ranked(first.unionByName(probe(second))).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")
