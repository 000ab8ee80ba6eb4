"""Connected components of a graph given by its links, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.tables import written

#: Far above the logarithm of any chain's length.
MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """From ``links`` (``a``, ``b``, both long): ``node`` and ``component``, the smallest node reachable.

    Nodes that are the smallest of their component are not listed. Alternates between hanging larger and smaller
    neighbours of every node on its smallest neighbour, until nothing changes; minima are combined before the shuffle
    and joined back, so that a node with very many links can be split. Each round is written to scratch storage.
    """
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = written(pairs, "links"), None
    for _ in range(MAX_ROUNDS):
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not state["n"] or state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(hung.unionByName(low.withColumnRenamed("m", "v")).distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
