"""Exact order statistics without sorting the rows.

Values are counted into bins that ascend with them. From the counts follows which
bin holds a wanted rank, and only the rows of these bins are looked at again, in
finer bins where they are still many. So what crosses the network are counts and
the distinct values of a few bins, never the rows, and a group may be of any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from merchlake.functions.joins import checked_broadcast
from merchlake.session import stored

# Distinct values of a bin that one task may sort.
FEW = 100_000
# Wanted ranks that are broadcast without a look at their bytes.
FEW_ROWS = 100_000
STEPS_PER_DOUBLING = 256
FINER = 4096
PREFIX = 2


def bin_of(value: str) -> Column:
    """A whole number that never falls as the number in a column rises; about 0.3 % wide. NaN is above all, NULL stays NULL."""
    v = f"CAST(`{value}` AS DOUBLE)"
    place = f"(floor(log2(abs({v})) * {STEPS_PER_DOUBLING}) + 300000)"
    return F.expr(
        f"CAST(CASE WHEN isnan({v}) THEN 1000001 WHEN {v} = double('inf') THEN 1000000 WHEN {v} = double('-inf') THEN -1000000 "
        f"WHEN {v} = 0 THEN 0 WHEN {v} > 0 THEN {place} WHEN {v} < 0 THEN -{place} END AS BIGINT)"
    )


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", few: bool = False) -> DataFrame:
    """Join on keys, NULL equal to NULL; the right side is broadcast where it is small, or said to be `few` rows."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys])
    return left.join(F.broadcast(other) if few else checked_broadcast(other), on, how).drop(*[f"_r_{k}" for k in keys])


class Bins(NamedTuple):
    """Counts of `bin_of(value)`: a table (slot, _bin, _n), and the largest count in it."""

    table: DataFrame
    largest: int


def at_ranks(
    rows: DataFrame,
    slot: Sequence[str],
    value: str,
    wanted: DataFrame,
    weight: str | None = None,
    bins: Bins | None = None,
    few: bool = False,
) -> DataFrame:
    """slot, rank, value, before, n_equal: the row of each wanted 0-based rank, and how many rows of its slot are less or equal to it.

    `wanted` holds slot columns and `rank`, a few rows a slot; `few` says that it
    is small as a whole. `value` is a number or text; rows without one are left
    out. `weight` tells how many rows a row stands for. `bins` may give the counts
    of `bin_of(value)` where they are known already. Ranks beyond the slot give no
    row.
    """
    spoken = isinstance(rows.schema[value].dataType, StringType)
    one = F.col(weight) if weight else F.lit(1)
    known = rows.where(F.col(value).isNotNull()).select(*slot, F.col(value).alias("_v"), one.cast("long").alias("_n"))
    first = F.substring("_v", 1, PREFIX) if spoken else bin_of("_v")
    found = _search(known.withColumn("_bin", first), list(slot), wanted.select(*slot, "rank"), spoken, 1, bins, few)
    return found.select(*slot, "rank", F.col("_v").alias(value), "before", "n_equal")


def _running(slot: Sequence[str], order: str) -> Column:
    return F.sum("_n").over(Window.partitionBy(*slot).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def _search(rows: DataFrame, slot: list[str], wanted: DataFrame, spoken: bool, level: int, bins: Bins | None, few: bool) -> DataFrame:
    """`at_ranks` over (slot, _bin, _v, _n); calls itself for bins with many distinct values."""
    if bins is None:
        seen = Observation()
        counts = rows.groupBy(*slot, "_bin").agg(F.sum("_n").alias("_n"))
        table = stored(counts.observe(seen, F.max("_n").alias("largest")), "bins")
        bins = Bins(table, seen.get["largest"] or 0)
    upto = _running(slot, "_bin")
    ranges = bins.table.select(*slot, "_bin", (upto - F.col("_n")).alias("_from"), upto.alias("_to"))
    aims = _match(ranges, wanted, slot, few=few).where((F.col("rank") >= F.col("_from")) & (F.col("rank") < F.col("_to")))
    aims = aims.select(*slot, "_bin", "rank", "_from")
    if not few:  # stored, so that their true size decides on the broadcast
        aims = stored(aims, "aims")
    own = [*slot, "_bin"]
    cells = _match(rows, aims.select(*own).distinct(), own, few=few).groupBy(*own, "_v").agg(F.sum("_n").alias("_n"))
    split = False
    if bins.largest > FEW:  # else no bin has too many values
        low, high = (f(F.col("_v").cast("string" if spoken else "double")) for f in (F.min, F.max))
        cells = stored(cells, "cells")
        sizes = cells.groupBy(*own).agg(F.count(F.lit(1)).alias("_size"), low.alias("_low"), high.alias("_high"))
        # A bin whose ends are one number, or one text, cannot be parted further.
        many = (F.col("_size") > FEW) & (F.col("_low") < F.col("_high"))
        seen = Observation()
        sizes = sizes.withColumn("_many", F.coalesce(many, F.lit(False))).drop("_size")
        sizes = stored(sizes.observe(seen, F.max("_many").alias("many")), "sizes")
        split = bool(seen.get["many"])
    plain = _match(cells, sizes.where("NOT _many").select(*own), own) if split else cells
    upto = _running(own, "_v")
    ranked = plain.select(*own, "_v", (upto - F.col("_n")).alias("_inner"), F.col("_n").alias("_w"))
    inside = F.col("rank") - F.col("_from")
    hit = _match(ranked, aims, own, few=few).where((inside >= F.col("_inner")) & (inside < F.col("_inner") + F.col("_w")))
    found = hit.select(*slot, "rank", "_v", (F.col("_from") + F.col("_inner")).alias("before"), F.col("_w").alias("n_equal"))
    if not split:
        return found
    # The bins with many values become slots of their own.
    parted = {"_bin": f"_bin{level}"}
    deeper = [*slot, parted["_bin"]]
    large = sizes.where("_many").drop("_many")
    rest = _match(cells, large, own).withColumnsRenamed(parted)
    if spoken:
        finer = F.substring("_v", 1, PREFIX * (level + 1))
    else:
        share = (F.col("_v").cast("double") - F.col("_low")) / (F.col("_high") - F.col("_low"))
        finer = F.floor(share * FINER)
    rest = rest.withColumn("_bin", finer).drop("_low", "_high")
    aims = _match(aims, large.select(*own), own).withColumnsRenamed(parted)
    below = _search(rest, deeper, aims.select(*deeper, (F.col("rank") - F.col("_from")).alias("rank")), spoken, level + 1, None, few)
    back = _match(below, aims.select(*deeper, F.col("rank").alias("_rank"), "_from"), deeper).where(
        F.col("rank") == F.col("_rank") - F.col("_from")
    )
    return found.unionByName(
        back.select(*slot, F.col("_rank").alias("rank"), "_v", (F.col("_from") + F.col("before")).alias("before"), "n_equal")
    )


def with_percentiles(
    rows: DataFrame, group: Sequence[str], value: str, probs: dict[str, float], aggs: Sequence[Column] = ()
) -> DataFrame:
    """One row per group: the group, `aggs`, and a linearly interpolated percentile for each entry of `probs`.

    The other aggregates and the counts of the bins come out of one pass over
    the rows; the second pass reads only the rows of the bins that hold a wanted
    rank. NULL values are ignored; a group without values has NULL percentiles.
    Without a group there is one row, also for no rows.
    """
    if not group:
        # Grouping by nothing gives one row; sets of groups give none for no rows.
        made = with_percentiles(rows.withColumn("_all", F.lit(1)), ["_all"], value, probs, aggs)
        none = rows.limit(0).agg(*aggs, *[F.lit(None).cast("double").alias(p) for p in probs])
        made = stored(made.drop("_all"), "percentiles")
        return none if made.isEmpty() else made
    group = list(group)
    binned = rows.withColumn("_bin", bin_of(value))
    sets = [[*[F.col(g) for g in group], F.col("_bin")], [F.col(g) for g in group]]
    both = binned.groupingSets(sets, *group, "_bin").agg(
        *aggs, F.count(value).alias("_n"), F.grouping("_bin").alias("_whole")
    )
    seen, sub = Observation(), F.col("_whole") == 0
    both = stored(both.observe(seen, F.max(F.when(sub, F.col("_n"))).alias("largest"), F.count(F.when(~sub, 1)).alias("groups")), "bins")
    few = seen.get["groups"] * 2 * len(probs) <= FEW_ROWS
    bins = both.where((F.col("_whole") == 0) & (F.col("_n") > 0)).select(*group, "_bin", "_n")
    groups = both.where("_whole = 1").drop("_bin", "_whole")
    spots = []
    for i, p in enumerate(probs.values()):
        # A spot within 1e-9 of a whole rank is that rank.
        spot = f"({float(p)!r}D * (_n - 1))"
        low, apart = f"floor({spot} + 1e-9D)", f"({spot} - floor({spot} + 1e-9D))"
        part = f"IF({apart} > 1e-9D, {apart}, 0D)"
        spots.append(f"named_struct('i', {i}, 'low', {low}, 'high', {low} + CAST(ceil({part}) AS BIGINT), 'part', {part})")
    places = groups.where("_n > 0").select(*group, F.expr(f"inline(array({', '.join(spots)}))"))
    wanted = places.select(*group, F.expr("explode(array(low, high)) AS rank")).distinct()
    given = Bins(bins, seen.get["largest"] or 0)
    at = at_ranks(rows.select(*group, F.col(value).cast("double").alias("_value")), group, "_value", wanted, bins=given, few=few)
    hit = _match(at, places, group, few=few).where("rank = low OR rank = high")
    columns = []
    for i in range(len(probs)):
        columns += [
            f"max(IF(i = {i} AND rank = low, _value, NULL)) AS _low{i}",
            f"max(IF(i = {i} AND rank = high, _value, NULL)) AS _high{i}",
            f"max(IF(i = {i}, part, NULL)) AS _part{i}",
        ]
    picked = hit.groupBy(*group).agg(*[F.expr(c) for c in columns])
    values = picked.select(*group, *[F.expr(f"_low{i} + (_high{i} - _low{i}) * _part{i}").alias(n) for i, n in enumerate(probs)])
    return _match(groups.drop("_n"), values, group, "left", few=few)


def tiles_of(rows: DataFrame, orderings: dict[str, Column], key: str, tiles: int) -> DataFrame:
    """Add a tile number (1 to `tiles`, as ntile) for each ordering, ascending, ties by `key`.

    `orderings` names numbers; NULL comes first. The first row of each tile is
    looked up by its rank: the value from bins of all orderings at once, then the
    key among the rows of that value. All rows are then compared with these few
    borders, so no row moves. `key` is a number or text, unique and not NULL.
    """
    names = list(orderings)
    n = rows.count()
    base, longer = divmod(n, tiles)
    starts = [t * base + min(t, longer) for t in range(1, tiles)]
    starts = sorted({s for s in starts if 0 < s < n})
    if not starts:  # at most one row, or none
        return rows.withColumns({name: F.lit(1) for name in names})
    least = F.lit(float("-inf"))
    measured = rows.withColumns({f"_o_{c}": F.coalesce(o.cast("double"), least) for c, o in orderings.items()})
    long = measured.select(
        F.col(key).alias("_key"), F.inline(F.array(*[F.struct(F.lit(c).alias("ordering"), F.col(f"_o_{c}").alias("v")) for c in names]))
    )
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(c, s) for c in names for s in starts], "ordering STRING, rank LONG")
    values = at_ranks(long, ["ordering"], "v", wanted, few=True).collect()  # tiles - 1 an ordering
    inner = spark.createDataFrame(
        sorted({(r["ordering"], r["v"], r["rank"] - r["before"]) for r in values}), "ordering STRING, v DOUBLE, rank LONG"
    )
    tied = _match(long, inner.select("ordering", "v").distinct(), ["ordering", "v"], few=True)
    if sum({(r["ordering"], r["v"]): r["n_equal"] for r in values}.values()) <= FEW:
        place = F.row_number().over(Window.partitionBy("ordering", "v").orderBy("_key")) - 1
        keys = _match(tied.withColumn("rank", place.cast("long")), inner, ["ordering", "v", "rank"], few=True)
    else:
        keys = at_ranks(tied, ["ordering", "v"], "_key", inner, few=True)
    borders = keys.groupBy("ordering").agg(F.collect_list(F.struct("v", "_key")).alias("_b")).collect()
    kind = rows.schema[key].dataType
    out = {}
    for name in names:
        here = next(r["_b"] for r in borders if r["ordering"] == name)
        value = F.col(f"_o_{name}")
        reached = [
            ((value > b["v"]) | ((value == b["v"]) & (F.col(key) >= F.lit(b["_key"]).cast(kind)))).cast("int") for b in here
        ]
        out[name] = reduce(lambda a, b: a + b, reached, F.lit(1))
    return measured.withColumns(out).drop(*[f"_o_{c}" for c in names])
