"""Connected components of a table of edges, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncolake.operators.staging import stage_table


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternates large-star and small-star steps until nothing changes; the number of rounds grows
    with the logarithm of the longest path. Each round is written to the shared folder, so lineage
    stays short and lost executors cost one round. Edges of a null end count as none.
    """
    edges = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    current = stage_table(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    for _ in range(rounds):
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours of each node are tied to its smallest neighbour.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        # Small star: a node and its smaller neighbours are tied to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = tied.unionAll(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        after = stage_table(after, "edges")
        sums = [_sums(current), _sums(after)]
        current = after
        if sums[0] == sums[1]:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _sums(edges: DataFrame) -> tuple:
    """Equal for equal tables: row count and sums of hashes."""
    mixed = F.xxhash64("u", "v")
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.shiftright(mixed, 20)), F.sum(mixed.bitwiseAND(F.lit((1 << 20) - 1)))
        ).first()
    )
