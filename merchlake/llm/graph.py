"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import kept


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (columns u, v); root is the least node reachable.

    Large-star and small-star steps take turns until the edges are stars around
    the least nodes. Only a count and a checksum of the edges come to the driver.
    """
    down = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    current = kept(edges.where("u <> v").select(*down).distinct())
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_v")).select("_u", F.least("_u", "_v").alias("_m"))
        large = both.join(least, F.col("u") == F.col("_u")).where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        large = large.distinct()
        least = large.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
        small = large.join(least, F.col("u") == F.col("_u")).select("u", "v", "_m")
        small = small.select(F.col("u"), F.col("_m").alias("v")).unionByName(
            small.where("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        )
        current = kept(small.distinct())
        state, before = _state(current), state
        if state == before:
            break
    roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
