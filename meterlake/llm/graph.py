"""Connected components of a distributed edge table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import stored


def _smallest(edges: DataFrame) -> DataFrame:
    """Smallest endpoint next to each ``u`` (itself included): a map-side combined minimum."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of ``u`` to the smallest neighbour of ``u``."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_smallest(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link ``u`` and all its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _smallest(down)
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def _signature(edges: DataFrame) -> tuple:
    """Count and checksums of distinct edges: equal when a round changed nothing."""
    mix = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mix), F.bit_xor(F.xxhash64(mix, "u"))).first())


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``u`` and ``v``, long).

    ``root`` is the smallest node of the component. Large-star and small-star
    steps alternate until the edges are stars; each round is a minimum per node
    (combined before the shuffle) and a join that can be split at hot nodes, and
    is written to the shared folder. Rounds grow with the logarithm of the
    diameter. Loops and repeated edges are allowed; no edges give no rows.
    """
    edges = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    state = stored(edges.where("u <> v").distinct(), "edges")
    mark = _signature(state)
    for _ in range(max_rounds):
        state = stored(_small_star(_large_star(state).distinct()).where("u <> v").distinct(), "edges")
        before, mark = mark, _signature(state)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = state.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root")).distinct()
