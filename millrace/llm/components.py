"""Connected components of links between long keys, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

#: Rounds before giving up; the number needed grows with the logarithm of the longest chain.
MAX_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("u").alias("a"), F.col("v").alias("b")).union(links.select(F.col("v").alias("a"), F.col("u").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the node's least neighbour."""
    sides = _both_ways(links)
    # A written side, so that Spark can split a node with very many links.
    least = stored(sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least-neighbours")
    return sides.filter("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below it are linked to the least of these."""
    down = links.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("a").alias("u"), F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of a link (u, v); root is the least node that links reach.

    Alternates two star steps until nothing changes. A step only needs the least neighbour of a node, which is
    aggregated before it is joined, so a node with very many links is no group in one task. Each round is written to
    the shared folder. Links between equal nodes count for nothing; an empty table gives no rows.
    """
    now = stored(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _state(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        now = stored(_small_star(_large_star(now)), "links")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
