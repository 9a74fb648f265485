"""Order-based results over groups of any size.

A window over one big group runs in one task. Here rows are first cut into
ranges of (group, order) by Spark's range partitioner, so one group may span
many tasks; a small per-range summary then carries counts or border rows from
one range to the next. The range number is written with `checkpoint()`, hence
it stays the same when executors are lost and their tasks run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.functions.joins import source_bytes
from merchlake.session import MB, scratch_root

PIECE, HALO = "_piece", "_halo"
RANGE_BYTES = 64 * MB
MOST_RANGES = 64
# Groups are counted in so many buckets; a bucket of up to so many rows is left to plain windows over its groups.
GROUP_BUCKETS = 65_536
HEAVY_ROWS = 250_000


def _ordering(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def cut_into_ranges(df: DataFrame, group: Sequence[str], order: Sequence, pieces: int | None = None) -> DataFrame:
    """Tag each row with the number of its range; ranges ascend in (group, order)."""
    spark = df.sparkSession
    scratch_root(spark)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Not the estimate of the frame itself: that of a join is a product, and every range costs a task in each later step.
    # The sizes of some sources are not known, so they may only raise the number so far.
    count = pieces or min(max(usual, source_bytes(df) // RANGE_BYTES + 1), MOST_RANGES * usual)
    ranged = df.repartitionByRange(count, *[F.col(g) for g in group], *_ordering(order))
    return ranged.withColumn(PIECE, F.spark_partition_id()).checkpoint()


def running_weight(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence,
    weight: str,
    before: str = "before",
    total: str = "group_total",
    pieces: int | None = None,
) -> DataFrame:
    """Add the weight of all earlier rows of the group, and the group's total weight.

    Rows equal in `order` must have been merged before, or `order` must be unique.
    The totals per (group, range) are at most ranges + groups rows.
    """
    cut = cut_into_ranges(df, group, order, pieces)
    sums = cut.groupBy(*group, PIECE).agg(F.sum(weight).alias("_piece_weight"))
    by_piece = Window.partitionBy(*group).orderBy(PIECE)
    whole = Window.partitionBy(*group)
    offsets = sums.select(
        *_renamed([*group, PIECE]),
        (F.sum("_piece_weight").over(by_piece) - F.col("_piece_weight")).alias("_offset"),
        F.sum("_piece_weight").over(whole).alias(total),
    )
    inside = Window.partitionBy(*group, PIECE).orderBy(*_ordering(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("_local", F.sum(weight).over(inside) - F.col(weight))
    joined = local.join(offsets, _same([*group, PIECE]))
    return joined.select(
        *df.columns,
        (F.col("_offset") + F.col("_local")).alias(before),
        F.col(total),
    )


def _renamed(keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]


def _same(keys: list[str]) -> Column:
    """Null-safe match of the keys with their `_renamed` copies."""
    matches = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return reduce(lambda a, b: a & b, matches)


def row_numbers(df: DataFrame, group: Sequence[str], order: Sequence, name: str = "rn", total: str = "n_rows",
                pieces: int | None = None) -> DataFrame:
    """row_number() and count(*) per group for groups of any size; `order` must be unique."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_weight(one, group, order, "_one", before="_before", total=total, pieces=pieces)
    return ranked.withColumn(name, F.col("_before") + 1).drop("_before", "_one")


def tile(rn: Column, n_rows: Column, tiles: int) -> Column:
    """ntile from a row number: the first (n mod tiles) tiles hold one row more."""
    base = F.floor(n_rows / F.lit(tiles))
    longer = F.pmod(n_rows, F.lit(tiles))
    cutoff = longer * (base + 1)
    within_long = F.floor((rn - 1) / (base + 1)) + 1
    within_short = longer + F.floor((rn - 1 - cutoff) / F.greatest(base, F.lit(1))) + 1
    return F.when(rn <= cutoff, within_long).otherwise(within_short).cast("int")


def _bucket(group: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(g) for g in group]), F.lit(GROUP_BUCKETS)).cast("int")


def heavy_buckets(df: DataFrame, group: Sequence[str], most: int = HEAVY_ROWS) -> list[int]:
    """Buckets of hashed groups with more than `most` rows: only these can hold a group too big for a task.

    At most rows / `most` numbers. One pass, in which GROUP_BUCKETS counts a task are shuffled.
    """
    counts = df.groupBy(_bucket(group).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    return sorted(r["_bucket"] for r in counts.where(F.col("_n") > most).select("_bucket").collect())


def neighbours(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    pieces: int | None = None,
    heavy: list[int] | None = None,
) -> DataFrame:
    """lag(1) and lead(1) per group, for groups of any size.

    `previous` and `following` map new column names to source columns. `order`
    must be unique inside the group. Groups in `heavy` buckets (see
    heavy_buckets; looked up unless given) are cut into ranges, the others go
    through plain windows in one shuffle. With `pieces`, or without a group, all
    rows are cut into ranges.
    """
    previous, following = previous or {}, following or {}
    if pieces or not group:
        return _across_ranges(df, group, order, previous, following, pieces)
    heavy = heavy_buckets(df, group) if heavy is None else heavy
    inside = Window.partitionBy(*group).orderBy(*_ordering(order))

    def windowed(rows: DataFrame) -> DataFrame:
        return rows.select(
            *[F.col(f"`{c}`") for c in df.columns],
            *[F.lag(F.col(src)).over(inside).alias(name) for name, src in previous.items()],
            *[F.lead(F.col(src)).over(inside).alias(name) for name, src in following.items()],
        )

    if not heavy:
        return windowed(df)
    is_heavy = _bucket(group).isin(heavy)
    return windowed(df.where(~is_heavy)).unionByName(
        _across_ranges(df.where(is_heavy), group, order, previous, following, None)
    )


def _across_ranges(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    previous: dict[str, str],
    following: dict[str, str],
    pieces: int | None,
) -> DataFrame:
    """`neighbours` range by range: rows at a range border take their neighbour from the first/last rows of the group's adjoining ranges."""
    cut = cut_into_ranges(df, group, order, pieces)
    inside = Window.partitionBy(*group, PIECE).orderBy(*_ordering(order))
    carried = sorted({*previous.values(), *following.values()})
    row = F.struct(*[F.col(c) for c in carried])
    position = F.struct(*[F.col(o) for o in order])
    borders = cut.groupBy(*group, PIECE).agg(
        F.min_by(row, position).alias("_first"), F.max_by(row, position).alias("_last")
    )
    across = Window.partitionBy(*group).orderBy(PIECE)
    borders = borders.select(
        *_renamed([*group, PIECE]),
        F.lag("_last").over(across).alias("_prev_last"),
        F.lead("_first").over(across).alias("_next_first"),
    )
    local = cut.withColumn("_prev", F.lag(row).over(inside)).withColumn("_next", F.lead(row).over(inside))
    joined = local.join(borders, _same([*group, PIECE]), "left")
    prev_row = F.coalesce(F.col("_prev"), F.col("_prev_last"))
    next_row = F.coalesce(F.col("_next"), F.col("_next_first"))
    return joined.select(
        *df.columns,
        *[prev_row[src].alias(name) for name, src in previous.items()],
        *[next_row[src].alias(name) for name, src in following.items()],
    )


def with_halo(df: DataFrame, group: Sequence[str], order: Sequence[str], before: int, pieces: int | None = None) -> DataFrame:
    """The rows cut into ranges (PIECE), each with the `before` rows of its group that come before it, marked by HALO.

    Frames that reach back at most so many rows can then be computed inside the
    ranges, and the marked rows dropped. Only the last rows of the ranges, as
    arrays of `before` rows, move between them. `order` must be unique inside the
    group.
    """
    cut = cut_into_ranges(df, group, order, pieces)
    newest = Window.partitionBy(*group, PIECE).orderBy(*[F.desc(o) for o in order])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    ends = cut.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= before)
    tails = ends.groupBy(*group, PIECE).agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("o"), row.alias("row")))).alias("_tail"))
    # Every range with rows of the group has a last one, so the wanted rows lie in the `before` ranges before.
    across = Window.partitionBy(*group).orderBy(PIECE).rowsBetween(-before, -1)
    reach = tails.withColumn("_reach", F.flatten(F.collect_list("_tail").over(across)))
    last = F.slice("_reach", F.greatest(F.size("_reach") - before, F.lit(0)) + 1, before)
    halo = reach.select(PIECE, F.explode(F.transform(last, lambda x: x["row"])).alias("_row")).select("_row.*", PIECE)
    return cut.withColumn(HALO, F.lit(False)).unionByName(halo.withColumn(HALO, F.lit(True)))
