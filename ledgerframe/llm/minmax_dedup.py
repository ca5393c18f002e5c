"""MinHash near-dedup by min-max hashing (operator 11).

A text's set holds its distinct runs of ``SHINGLE_WORDS`` words; a text of fewer words is
one run. Under each of ``GROUPS * ROWS`` hash functions both the least and the greatest
value of a set are kept, so one evaluation gives two signature values. The least values
under ``ROWS`` functions make a band, the greatest under the same functions another. Two
sets at Jaccard similarity s agree in a band with chance s ** ROWS; a least and a greatest
value tend to be missed apart rather than together, so the bands of one group miss a pair
with a chance of (1 - s ** ROWS) ** 2 at most. At s = 0.8 all ``2 * GROUPS`` bands miss it
with a chance of 7e-6; candidates are confirmed on their full sets.

Equal sets are folded into one class first, copies included. Classes that agree in a band
form a bucket. A bucket is compared with one hub, not by pairs: the member that agrees with most
others in all its buckets. Members that the links found so far leave in different
components of a bucket are put into new buckets by the rarest shingles of their sets (prefix
filter: sets of the asked similarity share one of the first fifth). A set with a fifth of
its own shingles meets nobody there, so a group of near copies or a shared passage isn't
compared by pairs. All members of such a bucket meet its centre, the one with the fewest
shingles of its own. What two members have in common is bounded by what each has of the
centre and what each has beyond it in others' sets; where that is enough they meet in turn,
with 16 hubs, 128 and so on, until all members are connected or have been hubs. Two
members of several buckets meet in the one with the least key alone. So the
components are those of all candidate pairs.

Defined cases: a null or empty text, or one of white space alone, has an empty set, links to
nothing and is its own component; rows are separate whatever their ids, so repeated rows
are one component and all of them carry its least id; rows with a null id take no part in
the choice of the least id (a component of such rows alone has a null component id, and
``kept`` is true); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerframe.llm.common import cut, join_groups, mix, shingles, stored, word_hashes
from ledgerframe.llm.components import connected_components

SHINGLE_WORDS = 4
PERCENT = 80
#: Groups of hash functions, two bands each, and functions in a group.
GROUPS, ROWS = 15, 5
#: Least bucket keys that each member knows of itself.
LEAST_KEYS = 6
#: Texts are sketched together until they hold this many shingles.
_CHUNK = 1 << 15
_RNG = np.random.default_rng(11)
_XOR = _RNG.integers(0, 1 << 63, GROUPS * ROWS, np.uint64)
_ODD = _RNG.integers(0, 1 << 63, GROUPS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_KEYS = _RNG.integers(0, 1 << 63, 2, np.uint64)


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles."""
    words = word_hashes(text)
    return np.unique(shingles(words, min(size, len(words)))) if len(words) else words


def set_keys(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart, as two numbers for each set of ``values``."""
    hi, lo = (np.add.reduceat(mix(values ^ k), starts) for k in _KEYS)
    return mix(hi).view(np.int64), mix(lo).view(np.int64)


def min_max_bands(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Band keys, one row for each set: ``GROUPS`` of least values, ``GROUPS`` of greatest ones."""
    out = np.zeros((len(starts), 2 * GROUPS), np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    for f, (x, a) in enumerate(zip(_XOR, _ODD)):
        hashed = (values ^ x) * a
        group = f // ROWS
        for band, least in ((group, np.minimum), (GROUPS + group, np.maximum)):
            out[:, band] = mix((out[:, band] ^ least.reduceat(hashed, starts)) * odd + np.uint64(band))
    return out.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """``(d, r, n, hi, lo, bands)`` of every row: id, row key, set size, set key and band keys."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def of_chunk(rows: pd.DataFrame, sets: list[np.ndarray]) -> pd.DataFrame:
        size = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(size)
        hi, lo = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
        bands = [None] * len(sets)
        if len(full):
            values = np.concatenate(sets)
            starts = (np.cumsum(size) - size)[full]
            hi[full], lo[full] = set_keys(values, starts)
            for k, row in zip(full.tolist(), min_max_bands(values, starts)):
                bands[k] = row
        return pd.DataFrame({"d": rows["d"].to_numpy(), "r": rows["r"].to_numpy(), "n": size, "hi": hi, "lo": lo,
                             "bands": bands})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first, sets, held = 0, [], 0
            for k, text in enumerate(batch["t"]):
                sets.append(shingle_set(text, shingle_words))
                held += len(sets[-1])
                if held >= _CHUNK:
                    yield of_chunk(batch.iloc[first:k + 1], sets)
                    first, sets, held = k + 1, [], 0
            if sets:
                yield of_chunk(batch.iloc[first:], sets)

    return _rows(docs, id_col, text_col).mapInPandas(
        run, f"d {id_type}, r long, n long, hi long, lo long, bands array<long>")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"),
                       F.xxhash64(id_col, text_col).alias("r"))


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """``(node, s)``: the full set of each wanted class ``(node, r, hi, lo)``, from one of its rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, text, hi, lo in zip(batch["node"], batch["t"], batch["hi"], batch["lo"]):
                found = shingle_set(text, shingle_words)
                # another row may have the same row key
                if len(found) and [int(k[0]) for k in set_keys(found, np.array([0]))] == [hi, lo]:
                    yield pd.DataFrame({"node": [node], "s": [found.view(np.int64)]})

    texts = _rows(docs, id_col, text_col).select("r", "t").join(wanted, "r")
    return texts.mapInPandas(run, "node long, s array<long>").dropDuplicates(["node"])


def _overlaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b, common, linked)`` of pairs, from their full sets."""
    left = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    total = (F.size("sa") + F.size("sb")).cast("long")
    return both.select("a", "b", common.alias("common"), total.alias("total")).select(
        "a", "b", "common", ((100 + F.lit(percent)) * F.col("common") >= percent * F.col("total")).alias("linked"))


def _centres(members: DataFrame) -> DataFrame:
    """``(key, hub)``: each bucket's member with the highest score, the least one among equals."""
    best = members.groupBy("key").agg(F.max(F.struct("score", -F.col("node"))).alias("m"))
    return best.select("key", (-F.col("m.col2")).alias("hub"))


def _hubs(members: DataFrame, many: int) -> DataFrame:
    """Of each bucket the ``many`` members with the highest score, the best with ``hub_k`` 1."""
    # a partition's rows of a bucket are cut to as many before they are shuffled
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.col("score").desc(), "node"))
    return members.withColumn("k", place).where(F.col("k") <= many).select(
        "key", F.col("node").alias("hub"), *[F.col(c).alias(f"hub_{c}") for c in ("n", "common", "beyond", "class", "k")])


def _least_keys(members: DataFrame) -> DataFrame:
    """``(node, keys)``: the least keys of all buckets of each member."""
    # at most the prefix of one set is gathered
    return members.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("key")), 1, LEAST_KEYS).alias("keys"))


def _meeting(members: DataFrame, hubs: DataFrame, keys: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: members and hubs of one bucket and different classes of which enough can be common.

    ``common`` shingles of a member are its bucket's centre's too and ``beyond`` more stand
    in other members' sets, so two members have no more in common than the lesser of each.
    That holds in each of their buckets, so one of them decides: the least among the keys
    that both know of. Without such a key a pair may come from several buckets.
    """
    most = F.least("common", "hub_common") + F.least("beyond", "hub_beyond")
    least = F.array_min(F.array_intersect("keys", "hub_keys"))
    hubs = hubs.join(keys.select(F.col("node").alias("hub"), F.col("keys").alias("hub_keys")), "hub")
    return (members.join(keys, "node").join(hubs, "key")
            .where(F.col("k").isNull() | (F.col("k") > F.col("hub_k")))  # of two hubs the better meets the other
            .where((F.col("node") != F.col("hub")) & (F.col("class") != F.col("hub_class")))
            .where((100 + percent) * most >= percent * (F.col("n") + F.col("hub_n")))
            .where(F.coalesce(least, "key") == F.col("key"))
            .select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")))


def _apart(members: DataFrame, of: DataFrame) -> DataFrame:
    """Members with their components as ``class``, where a bucket has several of them."""
    now = members.drop("class").join(of, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")
    several = now.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x != y")
    return stored(now.join(several.select("key"), "key", "left_semi"))


def _prefixes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members again, in buckets by the rarest shingles of their sets.

    Two sets of the asked similarity share one of the ``n - ceil(percent * n / 100) + 1``
    first shingles of each in any one order. Here the rarest among these members come first;
    those that stand in one set alone make no bucket. ``held`` of a set's shingles stand in others too.
    """
    nodes = members.select("node", "n", "class").distinct()
    every = nodes.select("node").join(sets, "node").select("node", F.explode("s").alias("key"))
    often = every.groupBy("key").agg(F.count("*").alias("f")).where("f > 1")
    place = Window.partitionBy("node").orderBy("f", "key")
    every = every.join(often, "key").withColumn("at", F.row_number().over(place)).withColumn(
        "held", F.count("*").over(Window.partitionBy("node")))
    first = F.floor((100 - percent) * F.col("n") / 100) + 1 - (F.col("n") - F.col("held"))
    return nodes.join(every, "node").where(F.col("at") <= first).select("key", "node", "n", "held", "class")


def components(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, shingle_words: int,
               percent: int) -> DataFrame:
    """``(node, root)``: the components of classes by all confirmed candidate pairs."""
    members = classes.select("node", "n", F.explode("bands").alias("key"))
    counts = members.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    members = stored(members.join(counts, "key"))
    score = members.groupBy("node").agg(F.sum("c").alias("score"))
    wanted = score.select("node").join(classes.select("node", "r", "hi", "lo"), "node")
    sets = stored(_sets(docs, wanted, id_col, text_col, shingle_words))
    members = stored(members.drop("c").join(score, "node").withColumn("class", F.col("node")))
    # bands: one hub a bucket
    near = members.join(_centres(members), "key").where("node <> hub").join(
        classes.select(F.col("node").alias("hub"), F.col("n").alias("hub_n")), "hub")
    tested = cut(near.where(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
                 .select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct())
    found = cut(_overlaps(tested, sets, percent).where("linked").select("a", "b"))
    of = connected_components(found, "a", "b")
    members = _apart(members.drop("score"), of)
    if members.isEmpty():
        return of
    # rarest shingles: a centre that all members of a bucket meet, the one with the fewest shingles of its own
    members = _apart(_prefixes(members, sets, percent).withColumn("score", F.col("held") - F.col("n")), of)
    centres = stored(members.join(_centres(members), "key"))
    met = centres.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    met = stored(_overlaps(met, sets, percent))
    tested = cut(tested.unionByName(met.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).distinct())
    found = cut(found.unionByName(met.where("linked AND a <> b").select("a", "b")))
    of = connected_components(found, "a", "b")
    members = centres.join(met.select(F.col("a").alias("node"), F.col("b").alias("hub"), "common"), ["node", "hub"]) \
        .where("node <> hub").withColumn("beyond", F.col("held") - F.col("common")).drop("hub", "held")
    members, many = _apart(members, of), 16
    keys = stored(_least_keys(members))
    while not members.isEmpty():
        hubs = cut(_hubs(members, many))
        members = members.join(hubs.select("key", F.col("hub").alias("node"), F.col("hub_k").alias("k")),
                               ["key", "node"], "left")
        near = cut(_meeting(members, hubs, keys, percent).distinct().join(tested, ["a", "b"], "left_anti"))
        new = cut(_overlaps(near, sets, percent).where("linked").select("a", "b"))
        tested = tested.unionByName(near)
        if not new.isEmpty():
            found = found.unionByName(new)
            of = connected_components(found, "a", "b")
        members = _apart(members.where(F.col("k").isNull()).drop("k"), of)
        many *= 8
    return of


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``id_col, n_shingles, component_id, kept``, one row per input row."""
    rows = stored(sketches(docs, id_col, text_col, shingle_words))
    classes = rows.where("n > 0").groupBy("hi", "lo").agg(
        F.min("d").alias("first"), F.count("*").alias("copies"), F.min("r").alias("r"),
        F.first("n").alias("n"), F.first("bands").alias("bands"))
    # written before it is read again, so that each class keeps its number
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))
    of = components(docs, classes, id_col, text_col, shingle_words, percent)
    firsts = classes.select("node", "hi", "lo", "first", "copies")
    linked = cut(of.join(firsts.select("node", "first"), "node"))
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    groups = firsts.join(linked.join(least, "root").select("node", "least"), "node", "left") \
        .withColumn("least", F.coalesce("least", "first"))
    groups = cut(groups.select("hi", "lo", "copies", "least"))
    full = join_groups(rows.where("n > 0").select("d", "n", "hi", "lo"), groups, ["hi", "lo"], "copies")
    full = full.select("d", "n", F.col("least").alias("c"))
    empty = rows.where("n = 0").select("d", "n", F.col("d").alias("c"))
    return full.unionByName(empty).select(
        F.col("d").alias(id_col), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"),
        F.col("d").eqNullSafe(F.col("c")).alias("kept"))
