"""Joins whose broadcast is size-checked and whose hot keys are split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from merchlake.session import MB

BROADCAST_LIMIT = 32 * MB
HOT_SALTS = 64
MAX_HOT_KEYS = 1000
MIN_SAMPLED = 50


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; joins and aggregates are estimated high, so it errs to the safe side."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def source_bytes(df: DataFrame) -> int:
    """Size of what a frame reads, summed over its sources: grows with the input, however the frame joins them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def small_enough(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    return estimated_bytes(df) <= limit


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only below the limit; otherwise the frame goes back unhinted."""
    return F.broadcast(df) if small_enough(df, limit) else df


def hot_keys(df: DataFrame, key: str, share: float = 0.005, fraction: float = 0.01, seed: int = 7) -> list:
    """Keys seen in more than `share` of a row sample, heaviest first.

    The sample only steers how rows are spread, never which rows come out, so
    a missed key costs time and nothing else. At most MAX_HOT_KEYS come back.
    """
    sample = df.select(key).where(F.col(key).isNotNull()).sample(fraction=fraction, seed=seed)
    counted = sample.groupBy(key).count()
    rows = counted.orderBy(F.desc("count"), key).limit(MAX_HOT_KEYS).collect()
    floor = max(share * sum(r["count"] for r in rows), MIN_SAMPLED)
    return [r[key] for r in rows if r["count"] > floor]


def spread_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    condition: Column | None = None,
    limit: int = BROADCAST_LIMIT,
    size: int | None = None,
    hot: list | None = None,
    salts: int = HOT_SALTS,
    aggregated: bool = False,
) -> DataFrame:
    """Join facts to a dimension on `key`, keeping the key column once.

    A dimension within the byte limit is broadcast: no shuffle, no skew. Its
    size is Catalyst's estimate, or `size` where the caller knows a bound (the
    estimate of a joined frame is a product and far too high).

    A larger dimension is shuffled. NULL text keys match nothing and are dealt
    out over the partitions. Partitions that a hot key makes too big are split
    at run time (see session.tune); keys known to be hot can also be listed in
    `hot` (see hot_keys) and are then dealt over `salts` partitions, with only
    their few dimension rows repeated. Set `aggregated` when the dimension comes
    out of an aggregation on the key: run-time splitting needs a shuffle right
    below the join, and the salt column brings one about.
    Supports inner, left, left_semi and left_anti.
    """
    renamed = dim.withColumnRenamed(key, "_dim_key")
    if (estimated_bytes(dim) if size is None else size) <= limit:
        on = F.col(key) == F.col("_dim_key")
        if condition is not None:
            on = on & condition
        return facts.join(F.broadcast(renamed), on, how).drop("_dim_key")

    rest = [F.col(c) for c in facts.columns if c != key and _hashable(facts, c)]
    dealt = F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int") if rest else F.lit(0)
    lookup = F.col(key)
    if isinstance(facts.schema[key].dataType, StringType) and rest:
        lookup = F.coalesce(lookup, F.concat(F.lit("\u0000"), dealt.cast("string")))
    on = F.col("_lookup") == F.col("_dim_key")
    if hot or aggregated:
        is_hot = F.col(key).isin(hot or []) | F.col(key).isNull()
        facts = facts.withColumn("_salt", F.when(is_hot, dealt).otherwise(F.lit(0)))
        repeated = F.when(F.col("_dim_key").isin(hot or []), F.sequence(F.lit(0), F.lit(salts - 1)))
        renamed = renamed.withColumn("_dim_salt", F.explode(F.coalesce(repeated, F.array(F.lit(0)))))
        on = on & (F.col("_salt") == F.col("_dim_salt"))
    if condition is not None:
        on = on & condition
    joined = facts.withColumn("_lookup", lookup).join(renamed, on, how)
    return joined.drop("_dim_key", "_dim_salt", "_salt", "_lookup")


def _hashable(df: DataFrame, column: str) -> bool:
    return "map<" not in df.schema[column].dataType.simpleString()


def flag_members(
    facts: DataFrame,
    keys: DataFrame,
    key: str,
    flag: str,
    limit: int = BROADCAST_LIMIT,
    size: int | None = None,
    hot: list | None = None,
) -> DataFrame:
    """Add a never-NULL boolean: does the fact's key occur among `keys`? Reads and shuffles the facts once."""
    size = estimated_bytes(keys) if size is None else size
    wanted = keys.select(F.col(keys.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    marked = wanted.withColumn(flag, F.lit(True))
    joined = spread_join(facts, marked, key, "left", limit=limit, size=size, hot=hot, aggregated=True)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
