import random

from conftest_llm import components

from ledgerframe.llm.components import connected_components


def check(spark, links):
    got = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    clean = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == components({n for p in clean for n in p}, clean)


def test_random_chain_star_and_noise(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 80)]
    noise = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    check(spark, chain + star + noise + [(None, 3), (4, None), (7, 7), (100, 101), (101, 100)])


def test_empty(spark):
    check(spark, [])
