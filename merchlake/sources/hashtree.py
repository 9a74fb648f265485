"""Changes between large snapshots, found by hash trees over ranges of hashed keys.

A snapshot is written in folders of key ranges with a small tree beside it: each
leaf holds the count and two sums of the row hashes of its range, each node above
the sums of its children. Two trees are compared from the top; only the ranges of
differing leaves are read and joined, so the work grows with the changes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.sources.snapshots import changes

FAN = 16
LEAVES, FOLDERS = FAN**3, 64
LEAF, FOLDER = "_leaf", "_folder"


def _row_hash(columns: Sequence[str], salt: int) -> Column:
    """Of all values, NULL included; map columns cannot be hashed."""
    parts = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(salt), *parts).cast("decimal(38,0)")


def _depth(leaves: int) -> int:
    depth = round(math.log(leaves, FAN))
    if FAN**depth != leaves or leaves > 2**24:
        raise ValueError(f"leaves must be a power of {FAN}, 2^24 at most")
    return depth


def write(df: DataFrame, path: str, key: Sequence[str], leaves: int = LEAVES, folders: int = FOLDERS) -> None:
    """Write a snapshot with unique keys and its tree. `folders` divides `leaves`; rows lie sorted by leaf."""
    spark, columns, depth = df.sparkSession, df.columns, _depth(leaves)
    leaf = F.shiftrightunsigned(F.xxhash64(*key), 64 - int(math.log2(leaves))).cast("int")
    ranged = df.withColumn(LEAF, leaf).withColumn(FOLDER, F.floor(F.col(LEAF) / (leaves // folders)).cast("int"))
    ranged.repartitionByRange(folders, LEAF).sortWithinPartitions(FOLDER, LEAF).write.partitionBy(FOLDER).parquet(f"{path}/rows")
    sums = [F.count(F.lit(1)).alias("n"), F.sum(_row_hash(columns, 1)).alias("a"), F.sum(_row_hash(columns, 2)).alias("b")]
    written = spark.read.parquet(f"{path}/rows") if not df.isEmpty() else ranged
    level = written.groupBy(F.col(LEAF).alias("node")).agg(*sums)
    level.withColumn("level", F.lit(depth)).coalesce(1).write.partitionBy("level").parquet(f"{path}/tree")
    for d in range(depth - 1, -1, -1):
        below = _level(spark, path, d + 1)
        up = below.groupBy(F.floor(F.col("node") / FAN).cast("int").alias("node")).agg(*[F.sum(c).alias(c) for c in "nab"])
        up.withColumn("level", F.lit(d)).coalesce(1).write.mode("append").partitionBy("level").parquet(f"{path}/tree")


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    schema = "node int, n bigint, a decimal(38,0), b decimal(38,0), level int"
    return spark.read.schema(schema).parquet(f"{path}/tree").where(F.col("level") == level).drop("level")


def differing_leaves(spark: SparkSession, before: str, after: str, leaves: int = LEAVES) -> list[int]:
    """Leaves whose rows differ, looking only below nodes that differ. At most `leaves` numbers."""
    suspects: list[int] | None = None
    for level in range(_depth(leaves) + 1):
        old, new = (_level(spark, p, level) for p in (before, after))
        if suspects is not None:
            above = F.floor(F.col("node") / FAN).cast("int").isin(suspects)
            old, new = old.where(above), new.where(above)
        renamed = new.withColumnsRenamed({c: f"_{c}" for c in new.columns})
        same = (F.col("n") == F.col("_n")) & (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))
        both = old.join(renamed, F.col("node") == F.col("_node"), "full_outer")
        differ = both.where(~F.coalesce(same, F.lit(False))).select(F.coalesce("node", "_node").alias("node"))
        suspects = sorted(r["node"] for r in differ.collect())
        if not suspects:
            return []
    return suspects


def rows_of_leaves(spark: SparkSession, path: str, wanted: list[int], leaves: int = LEAVES, folders: int = FOLDERS) -> DataFrame:
    """The rows of some leaves: whole folders are passed over, and inside a folder the parts without such leaves."""
    places = sorted({x // (leaves // folders) for x in wanted})
    return spark.read.parquet(f"{path}/rows").where(F.col(FOLDER).isin(places) & F.col(LEAF).isin(wanted)).drop(LEAF, FOLDER)


def changes_between(spark: SparkSession, before: str, after: str, key: Sequence[str], leaves: int = LEAVES, folders: int = FOLDERS) -> DataFrame:
    """`snapshots.changes` of two written snapshots, reading differing ranges only."""
    wanted = differing_leaves(spark, before, after, leaves)
    old, new = (rows_of_leaves(spark, p, wanted, leaves, folders) for p in (before, after))
    return changes(old, new, list(key))
