"""Connected components of an edge list, for tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import discard, staged


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first())


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``node, root`` for every node of an edge that joins two nodes; ``root``
    is the smallest node (a long) that edges reach from it.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its smallest one, then its smaller neighbours. Minima
    combine before the shuffle, the joins have one row per node on one side
    (so a node with very many edges can be split), and each round is a
    written table, so a lost executor repeats one round at most.
    """
    u, v = F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")
    now = staged(edges.where(F.col(src) != F.col(dst)).select(u, v).distinct(), "components")
    mark = _mark(now)
    while mark[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = staged(large, "components")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        new = staged(small.unionAll(low.select("u", F.col("low").alias("v"))).distinct(), "components")
        discard(large)
        discard(now)
        now, old, mark = new, mark, _mark(new)
        if mark == old:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
