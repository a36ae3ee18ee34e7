"""Connected components of links that do not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.work import save

_ROUNDS = 60


def _hang(pairs: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each node on the least of them and the node: larger ones, or the rest and the node itself."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    joined = both.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it is linked with over any path, for nodes that are not the least.

    ``links`` has long columns ``a`` and ``b``; order, copies and self links do not matter.
    Alternates large-star and small-star until nothing changes (Kiveris et al., 2014): the links
    of a node are halved, never gathered, and each round is a written table.
    """
    pairs = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = save(pairs, "links")
    before = None
    for _ in range(_ROUNDS):
        pairs = save(_hang(_hang(pairs, True), False), "links")
        now = tuple(pairs.agg(F.count("a"), F.sum(F.hash("a", "b").cast("long"))).first())
        if now == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
    raise RuntimeError(f"links did not settle in {_ROUNDS} rounds")
