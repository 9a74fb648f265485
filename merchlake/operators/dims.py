"""Slowly changing dimensions and point-in-time joins, as pure functions of snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.functions.joins import BROADCAST_LIMIT, small_enough, spread_join
from merchlake.functions.ordering import PIECE, cut_into_ranges, heavy_buckets, neighbours
from merchlake.functions.scalars import OPEN_END, fingerprint

TRACKED = ["email", "city", "country", "phone"]
CARRIED = ["first_name", "last_name"]


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def _opened(source: DataFrame, key: str, payload: Sequence[str], as_of: datetime) -> DataFrame:
    return source.select(
        key,
        *payload,
        "row_hash",
        F.lit(True).alias("is_current"),
        F.lit(as_of).cast("timestamp").alias("valid_from"),
        _open_end().alias("valid_to"),
    )


def scd2_start(
    source: DataFrame,
    as_of: datetime,
    key: str = "customer_id",
    tracked: Sequence[str] = TRACKED,
    carried: Sequence[str] = CARRIED,
    null_token: str | None = "\u0000",
) -> DataFrame:
    """First load: every source row becomes an open version."""
    hashed = source.withColumn("row_hash", fingerprint(list(tracked), null_token))
    return _opened(hashed, key, [*carried, *tracked], as_of)


def scd2_apply(
    target: DataFrame,
    source: DataFrame,
    as_of: datetime,
    key: str = "customer_id",
    tracked: Sequence[str] = TRACKED,
    carried: Sequence[str] = CARRIED,
    null_token: str | None = "\u0000",
) -> DataFrame:
    """Next state of the dimension after one source snapshot (unique keys expected).

    Versions are half-open `[valid_from, valid_to)`. A key whose tracked
    columns changed gets its open version closed at `as_of` and a new one
    opened there; new keys are opened; keys absent from the source stay as
    they are. Closed history passes through without being shuffled.
    """
    payload = [*carried, *tracked]
    incoming = source.select(key, F.struct(*payload).alias("_new")).withColumn(
        "_new_hash", fingerprint([f"_new.{c}" for c in tracked], null_token)
    )
    columns = [key, *payload, "row_hash", "is_current", "valid_from", "valid_to"]
    current = F.coalesce(F.col("is_current"), F.lit(False))
    history = target.where(~current).select(*columns)
    open_rows = target.where(current).select(*columns, F.lit(True).alias("_had"))
    paired = open_rows.join(incoming, key, "full_outer")

    moment = F.lit(as_of).cast("timestamp")
    had = F.col("_had").isNotNull()
    came = F.col("_new_hash").isNotNull()
    changed = had & came & (F.col("row_hash") != F.col("_new_hash"))
    fields = [*payload, "row_hash", "is_current", "valid_from", "valid_to"]
    kept = _version([F.col(c) for c in fields], fields)
    closed = _version([*[F.col(c) for c in [*payload, "row_hash"]], F.lit(False), F.col("valid_from"), moment], fields)
    opened = _version(
        [*[F.col(f"_new.{c}") for c in payload], F.col("_new_hash"), F.lit(True), moment, _open_end()], fields
    )
    versions = F.when(changed, F.array(closed, opened)).when(had, F.array(kept)).otherwise(F.array(opened))
    renewed = paired.select(key, F.explode(versions).alias("_v")).select(key, "_v.*")
    return history.unionByName(renewed)


def _version(values: list[Column], names: list[str]) -> Column:
    return F.struct(*[v.alias(n) for v, n in zip(values, names)])


def scd1_apply(target: DataFrame, source: DataFrame, as_of: datetime, key: str = "product_id",
               stamp: str = "_last_updated") -> DataFrame:
    """Upsert: source rows win and are stamped, rows absent from the source stay (unique keys expected)."""
    attributes = [c for c in target.columns if c not in (key, stamp)]
    old = target.select(key, F.struct(*attributes, stamp).alias("_old"))
    new = source.select(
        key, F.struct(*attributes, F.lit(as_of).cast("timestamp").alias(stamp)).alias("_new")
    )
    merged = old.join(new, key, "full_outer").select(key, F.coalesce("_new", "_old").alias("_row"))
    return merged.select(key, "_row.*").select(*target.columns)


def scd1_start(source: DataFrame, as_of: datetime, key: str = "product_id", stamp: str = "_last_updated"):
    return source.withColumn(stamp, F.lit(as_of).cast("timestamp"))


def scd2_from_changes(
    changes: DataFrame,
    key: str,
    sequence: Sequence[str],
    tracked: Sequence[str],
    moment: str,
    pieces: int | None = None,
) -> DataFrame:
    """Versions from a log with many, possibly late, changes per key.

    Changes are ordered by `sequence` (unique per key). Entries equal to the
    one before are dropped; each remaining entry is valid until the next.
    Both neighbours of a key's changes come out of one shuffle; keys of much
    weight are cut into ranges, so one key may hold most of the log.
    """
    hashed = changes.withColumn("row_hash", fingerprint(list(tracked)))
    # Counted in the log: what is kept of a key is never more.
    heavy = None if pieces else heavy_buckets(changes, [key])
    with_before = neighbours(hashed, [key], list(sequence), previous={"_before": "row_hash"}, pieces=pieces, heavy=heavy)
    kept = with_before.where(~F.col("_before").eqNullSafe(F.col("row_hash"))).drop("_before")
    with_next = neighbours(kept, [key], list(sequence), following={"_until": moment}, pieces=pieces, heavy=heavy)
    return with_next.select(
        key,
        *tracked,
        "row_hash",
        F.col("_until").isNull().alias("is_current"),
        F.col(moment).alias("valid_from"),
        F.coalesce(F.col("_until"), _open_end()).alias("valid_to"),
    )


def scd2_problems(dim: DataFrame, key: str, pieces: int | None = None) -> DataFrame:
    """Keys without exactly one open version, or with versions that overlap."""
    ordered = neighbours(
        dim.select(key, "is_current", "valid_from", "valid_to"),
        [key],
        ["valid_from", "valid_to"],
        following={"_next_from": "valid_from"},
        pieces=pieces,
    )
    overlap = F.col("_next_from") < F.col("valid_to")
    report = ordered.groupBy(key).agg(
        F.count(F.when(F.col("is_current"), 1)).alias("open_versions"),
        F.count(F.when(overlap, 1)).alias("overlaps"),
    )
    return report.where((F.col("open_versions") != 1) | (F.col("overlaps") > 0))


# Versions of a key up to which a broadcast join looks through all of them for each fact.
FEW_VERSIONS = 100


def point_in_time_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    moment: str,
    attributes: Sequence[str],
    limit: int = BROADCAST_LIMIT,
    size: int | None = None,
    pieces: int | None = None,
    **join,
) -> DataFrame:
    """Each fact with the dimension version that was valid at its own time (left join).

    The versions of a key must not overlap (see `scd2_problems`). Where no key has
    more than FEW_VERSIONS of them, facts are joined to the versions of their key
    (`spread_join`; `size` is a known bound of the dimension's bytes). Else
    versions are carried along (`carry_versions`), so that no fact is paired with
    all versions of a key.
    """
    versions = dim.select(key, *attributes, "valid_from", "valid_to").where(F.col(key).isNotNull())
    most = versions.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    if most <= FEW_VERSIONS:
        valid = (F.col(moment) >= F.col("valid_from")) & (F.col(moment) < F.col("valid_to"))
        joined = spread_join(facts, versions, key, "left", condition=valid, limit=limit, size=size, **join)
        return joined.drop("valid_from", "valid_to")
    return carry_versions(facts, versions, key, moment, attributes, pieces)


def carry_versions(
    facts: DataFrame, versions: DataFrame, key: str, moment: str, attributes: Sequence[str], pieces: int | None = None
) -> DataFrame:
    """`point_in_time_join` for keys of any weight: linear in facts plus versions.

    Facts and versions are put in one order of key and time and cut into ranges,
    so a key may span many tasks. Inside a range a fact takes the last version
    before it; the last versions of the ranges before, one row per key and range,
    are carried over for the facts that stand before the range's first version.
    """
    row = F.struct(*[F.col(c) for c in (*attributes, "valid_to")])
    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    both = versions.select(F.col(key).alias("_k"), F.col("valid_from").cast("timestamp").alias("_t"), F.lit(0).alias("_kind"), row.alias("_version")).unionByName(
        facts.select(F.col(key).alias("_k"), F.col(moment).cast("timestamp").alias("_t"), F.lit(1).alias("_kind"), fact.alias("_fact")),
        allowMissingColumns=True,
    )
    cut = cut_into_ranges(both, ["_k"], ["_t", "_kind"], pieces)
    inside = Window.partitionBy("_k", PIECE).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = cut.withColumn("_seen", F.last("_version", ignorenulls=True).over(inside)).where("_kind = 1")
    ends = cut.where("_kind = 0").groupBy("_k", PIECE).agg(F.max_by("_version", "_t").alias("_end"))
    # One row for each range that a key has facts in, so that ranges without versions hand on what came before.
    spans = cut.groupBy("_k", PIECE).agg(F.count(F.lit(1)).alias("_n")).join(ends, ["_k", PIECE], "left")
    before = Window.partitionBy("_k").orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(
        F.col("_k").alias("_ck"), F.col(PIECE).alias("_cp"), F.last("_end", ignorenulls=True).over(before).alias("_carried")
    ).where("_carried IS NOT NULL")
    joined = seen.join(carried, (F.col("_k") == F.col("_ck")) & (F.col(PIECE) == F.col("_cp")), "left")
    version = F.coalesce("_seen", "_carried")
    valid = F.col("_t") < version["valid_to"]
    return joined.select("_fact.*", *[F.when(valid, version[a]).alias(a) for a in attributes])


def enrich(facts: DataFrame, reference: DataFrame, on: dict[str, str], limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Left join to a reference table on differently named (or composite) keys.

    `on` maps fact columns to reference columns. The reference keys are dropped.
    """
    renamed = reference.withColumnsRenamed({r: f"_ref_{r}" for r in on.values()})
    condition = [F.col(f) == F.col(f"_ref_{r}") for f, r in on.items()]
    hinted = F.broadcast(renamed) if small_enough(reference, limit) else renamed
    return facts.join(hinted, condition, "left").drop(*[f"_ref_{r}" for r in on.values()])


def unseen(source: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Source rows that have no open version in the dimension."""
    return source.join(dim.where("is_current").select(key), key, "left_anti")
