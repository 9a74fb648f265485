"""Versioned table snapshots in plain parquet folders (`<table>/v=000001`).

One writer per table is assumed. A version counts once its `_SUCCESS` marker
exists, so a job that dies half-way leaves no readable version behind.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class TooFewRows(RuntimeError):
    """A full load was smaller than its guard allows."""


def _folder(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def versions(spark: SparkSession, table: str) -> list[tuple[int, datetime]]:
    """Finished versions with their commit times, oldest first."""
    fs, root = _folder(spark, table)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v=") and fs.exists(marker):
            written = fs.getFileStatus(marker).getModificationTime() / 1000
            found.append((int(name[2:]), datetime.fromtimestamp(written, timezone.utc)))
    return sorted(found)


def exists(spark: SparkSession, table: str) -> bool:
    return bool(versions(spark, table))


def _next(spark: SparkSession, table: str) -> int:
    known = versions(spark, table)
    return known[-1][0] + 1 if known else 1


def _at(table: str, version: int) -> str:
    return f"{table.rstrip('/')}/v={version:06d}"


def overwrite(df: DataFrame, table: str, partition_by: list[str] | None = None, min_rows: int = 0) -> int:
    """Write a full new version, schema included, and return its number.

    With `min_rows` the written version is counted before it is published: a
    short load raises and the previous version stays the latest one.
    """
    spark = df.sparkSession
    version = _next(spark, table)
    target = _at(table, version)
    if min_rows:
        staged = f"{table.rstrip('/')}/_staged-{version:06d}"
        _writer(df, partition_by).parquet(staged)
        rows = spark.read.parquet(staged).count()
        if rows < min_rows:
            raise TooFewRows(f"{rows} rows, at least {min_rows} expected")
        fs, source = _folder(spark, staged)
        fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(target))
        return version
    _writer(df, partition_by).parquet(target)
    return version


def _writer(df: DataFrame, partition_by: list[str] | None):
    writer = df.write.mode("overwrite")
    return writer.partitionBy(*partition_by) if partition_by else writer


def append(df: DataFrame, table: str) -> int:
    """New version holding the previous rows and the new ones; new columns are kept."""
    spark = df.sparkSession
    merged = df if not exists(spark, table) else read(spark, table).unionByName(df, allowMissingColumns=True)
    return overwrite(merged, table)


def read(spark: SparkSession, table: str, version: int | None = None, as_of: datetime | None = None) -> DataFrame:
    """Latest version, a numbered one, or the last one committed at or before `as_of`."""
    known = versions(spark, table)
    if version is not None:
        chosen = [v for v, _ in known if v == version]
    elif as_of is not None:
        limit = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
        chosen = [v for v, moment in known if moment <= limit]
    else:
        chosen = [v for v, _ in known]
    if not chosen:
        raise FileNotFoundError(f"no such version of {table}")
    return spark.read.parquet(_at(table, chosen[-1]))


def upsert_or_create(spark: SparkSession, table: str, create, merge) -> int:
    """First run writes `create()`, later runs write `merge(current)`."""
    frame = merge(read(spark, table)) if exists(spark, table) else create()
    return overwrite(frame, table)


def purge(df: DataFrame, column: str, as_of: datetime, days: int = 90) -> DataFrame:
    """Rows still inside the retention time."""
    return df.where(F.col(column) >= F.lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))


def compact(df: DataFrame, table: str, keys: list[str], pieces: int) -> int:
    """Rewrite a version clustered by `keys`, so that later filters on them skip files."""
    return overwrite(df.repartitionByRange(pieces, *keys).sortWithinPartitions(*keys), table)


def changes(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Row-level changes from one snapshot to the next with a `_change_type`.

    Updated rows come out twice, as `update_preimage` and `update_postimage`.
    Keys have to be unique in each snapshot.
    """
    columns = [c for c in after.columns if c not in key]
    old = before.select(*key, F.struct(*columns).alias("_old"))
    new = after.select(*key, F.struct(*columns).alias("_new"))
    paired = old.join(new, key, "full_outer")
    gone, came = F.col("_new").isNull(), F.col("_old").isNull()
    differs = ~F.col("_old").eqNullSafe(F.col("_new"))
    tagged = paired.select(
        *key,
        F.explode(
            F.when(gone, F.array(_change("delete", "_old")))
            .when(came, F.array(_change("insert", "_new")))
            .when(differs, F.array(_change("update_preimage", "_old"), _change("update_postimage", "_new")))
        ).alias("_change"),
    )
    return tagged.select(*key, "_change.row.*", F.col("_change.kind").alias("_change_type"))


def _change(kind: str, row: str):
    return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))
