"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 60


def _with_least(links: DataFrame) -> DataFrame:
    """Each row (u, v) with ``m``, the least v of its u.

    The table of least values is cut off by a checkpoint, so that the join shuffles both of its
    sides itself and a node with very many links can be split over tasks.
    """
    least = links.groupBy("u").agg(F.min("v").alias("m")).checkpoint()
    return links.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = (_with_least(both).where("v > u")
             .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))
    return moved.distinct().checkpoint()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of those neighbours."""
    joined = _with_least(links)
    ends = joined.select(F.explode(F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
    return ends.select("e.u", "e.v").where("u != v").distinct().checkpoint()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root``: the least node of the component, for every node with a link.

    Roots are among the nodes. Needs a checkpoint folder. Every round is a few joins and
    pre-summed groupings over the links; the number of rounds grows with the logarithm of the
    longest path. Links of a node to itself count for nothing; no links give no rows.
    """
    current = (links.where(F.col(a) != F.col(b))
               .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .distinct().checkpoint())
    seen = _mark(current)
    for _ in range(ROUNDS if seen[0] else 0):
        current = _small_star(_large_star(current))
        now = _mark(current)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError("the components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
