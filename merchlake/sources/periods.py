"""Tables partitioned by period: loads that touch only their own periods, and retention by whole partitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession


def append(df: DataFrame, table: str, period: str) -> None:
    """Add rows as new files; nothing that lies there is read or written."""
    df.repartition(period).write.mode("append").partitionBy(period).parquet(table)


def replace(df: DataFrame, table: str, period: str) -> None:
    """Put the rows in place of those of the same periods; periods without a row here keep their files."""
    writer = df.repartition(period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(period).parquet(table)


def purge(spark: SparkSession, table: str, period: str, first_kept: date) -> list[str]:
    """Drop the partitions of a date column before `first_kept` and return their values; only folder names are read.

    Rows without a period (NULL) stay.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(table)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(root):
        name, _, value = status.getPath().getName().partition("=")
        if name == period and value[:4].isdigit() and date.fromisoformat(value) < first_kept:
            fs.delete(status.getPath(), True)
            dropped.append(value)
    return sorted(dropped)
