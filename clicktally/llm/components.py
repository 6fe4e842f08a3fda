"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rounds after which something must be wrong: components double their reach in each.
MOST_ROUNDS = 60


def _state(stars: DataFrame):
    """The number of links and a checksum that does not depend on their order."""
    return stars.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node that it reaches, for every node with a link.

    Links go both ways and may repeat; null ends and links to oneself are left out. Large and small
    stars alternate: first every neighbour above a node is linked to the smallest neighbour, then
    every neighbour below. The smallest neighbour comes from an aggregation with a partial step and a
    join that adaptive execution can split, so a node with many links is no single task's work. Each
    round is a checkpoint in the shared folder.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    stars = (
        links.filter(F.col(a) != F.col(b))
        .select(high.alias("node"), low.alias("root"))
        .distinct()
        .checkpoint()
    )
    state = _state(stars)
    for _ in range(MOST_ROUNDS):
        both = stars.unionByName(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), "node").alias("least"))
        large = (
            both.join(least, "node")
            .filter(F.col("root") > F.col("node"))
            .select(F.col("root").alias("node"), F.col("least").alias("root"))
            .distinct()
        )
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node")
        stars = (
            small.select("node", F.col("least").alias("root"))
            .unionByName(
                small.filter(F.col("root") != F.col("least")).select(
                    F.col("root").alias("node"), F.col("least").alias("root")
                )
            )
            .distinct()
            .checkpoint()
        )
        before, state = state, _state(stars)
        if state == before:
            return stars
    raise RuntimeError("the components did not settle")
