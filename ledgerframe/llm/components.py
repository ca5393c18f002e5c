"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a grouped minimum and an equi-join, so neither a hub nor a long chain ever
meets in one task: the minimum is pre-aggregated per input split, and Spark may split a
hub's side of the join. Chains shrink geometrically; each round ends in a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerframe.llm.common import cut

MAX_ROUNDS = 60


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("centre"), F.least("u", "low").alias("low"))
    return (both.join(least, F.col("u") == F.col("centre"))
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "centre")
    moved = (links.join(least, F.col("u") == F.col("centre"))
             .where(F.col("v") != F.col("low"))
             .select(F.col("v").alias("u"), F.col("low").alias("v")))
    return moved.unionByName(least.select(F.col("centre").alias("u"), F.col("low").alias("v"))).distinct()


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for every node that has a link; root is the component's least node.

    Nulls and self links are ignored; repeated links and either direction are fine; an
    empty table gives an empty result.
    """
    a, b = F.col(left), F.col(right)
    links = cut(links.where(a.isNotNull() & b.isNotNull() & (a != b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = _signature(links)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        links = cut(_small_star(_large_star(links)))
        now = _signature(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    member = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return member.unionByName(member.select(F.col("root").alias("node"), "root").distinct())
