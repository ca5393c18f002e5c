import random
from collections import defaultdict

import pytest
from conftest_llm import words
from pyspark.sql import functions as F

from ledgerframe.llm import mixing as M


def plain_targets(size):
    """Shares by weight; who would exceed twice the size stops there, the rest is shared again."""
    names = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, free, target = 1.5 * sum(size.values()), set(names), {}
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * size[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2 * size[s]
            free.discard(s)
    return target


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(5)
    sources = ["s%02d" % i for i in range(9)] + ["Ä", None]
    rows = [(i, words(rng, rng.choice([0, 1, 30, 200, 900])), "en",
             rng.choice(sources) if i % 3 else "s00", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return rows, docs, M.mix(docs).collect()


def test_sizes_targets_and_shares(mixed):
    rows, _, got = mixed
    size, source = {r[0]: len((r[1] or "").split()) for r in rows}, {r[0]: r[3] for r in rows}
    total = defaultdict(int)
    for d, s in source.items():
        total[s] += size[d]
    target, taken = plain_targets(total), defaultdict(int)
    assert sorted(r["doc_id"] for r in got) == sorted(size)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    for s in total:
        assert abs(taken[s] - target[s]) <= 2 * M.BLOCK_WORDS + 0.01 * target[s]


def test_reruns_agree_whatever_the_partitioning(mixed):
    _, docs, got = mixed
    assert sorted(M.mix(docs.repartition(7)).collect()) == sorted(got)


def test_pieces_are_the_takings(mixed):
    _, docs, got = mixed
    read = M.mixed_pieces(docs).groupBy("doc_id").agg(F.sum("words").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in read} == {r["doc_id"]: r["taken"] for r in got if r["taken"]}


def test_shard_counts_are_random_draws(spark):
    sources = spark.createDataFrame([("a", 600_000, 6000), ("b", 300_000, 3000), ("c", 100_000, 1000)],
                                    "src string, blocks long, allot long")
    got = M.draws(sources, shard_slots=500).where("shard is not null").groupBy("src", "shard").count().collect()
    share = {"a": 300, "b": 150, "c": 50}
    off = [(r["count"] - share[r["src"]]) / share[r["src"]] ** 0.5 for r in got]
    assert 0.3 < sum(x * x for x in off) / len(off) < 1.5 and max(map(abs, off)) < 5


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 4097])
def test_permutation(spark, n):
    got = spark.range(2 * n).select(M.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("=s"), 5).alias("b")).collect()
    assert sorted(r["b"] for r in got[:n]) == list(range(n)) == sorted(r["b"] for r in got[n:])


def test_permutation_is_no_line(spark):
    n = 5000
    got = [r[0] for r in spark.range(2 * n).select(
        M.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("=s"), 5).alias("b")).collect()]
    steps = [(b - a) % n for a, b in zip(got, got[1:])]
    # an affine map has one step; of n random steps about 1 - 1/e of all values occur
    assert len(set(steps)) > n * 0.55
    assert sum(a == b for a, b in zip(got[:n], got[n:])) < 10  # the second pass goes another way
    for part in (got[:n], got[n:]):  # a stretch of indexes falls on all tenths of the blocks alike
        tenths = [sum(b * 10 // n == k for b in part[:1000]) for k in range(10)]
        assert sum((x - 100) ** 2 / 100 for x in tenths) < 30


def test_multiplication_beyond_64_bits(spark):
    n = (1 << 40) - 87
    a, x = n - 12345, n - 987654321
    got = spark.range(1).select(M._times(F.lit(a), F.lit(x), F.lit(n))).first()[0]
    assert got == a * x % n


def test_defined_cases(edge_docs, clashing_docs, no_docs, rows_of):
    got = rows_of(M.mix(edge_docs))
    assert len(got) == edge_docs.count()
    assert all(r[4] == 0 for r in got if r[1] == 0) and all(r[4] <= 2 * r[1] for r in got)
    assert rows_of(M.mix(clashing_docs)) == got
    assert M.mix(no_docs).collect() == []


def test_all_texts_empty(spark, no_docs):
    docs = spark.createDataFrame([(1, "", "en", "s", 0), (2, None, "en", None, 0)], no_docs.schema)
    assert sorted(tuple(r) for r in M.mix(docs).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_no_python_in_the_plan(edge_docs, capsys):
    M.mix(edge_docs).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
