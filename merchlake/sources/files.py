"""Readers and writers for files, feeds and database tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from merchlake.functions.joins import checked_broadcast


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_reference(spark: SparkSession, path: str, schema: StructType, booleans: tuple[str, ...] = ()) -> DataFrame:
    """A small reference CSV, hinted for broadcast if its size allows; "true"/"false" columns become BOOLEAN."""
    rows = read_csv(spark, path, schema).withColumns({c: F.col(c).try_cast("boolean") for c in booleans})
    return checked_broadcast(rows)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A reference table written in code; the driver holds it, so it has to stay tiny."""
    return spark.createDataFrame(rows, schema)


def with_lineage(df: DataFrame, as_of: datetime | None = None, stamp: str = "_ingested_at") -> DataFrame:
    """File of origin and load time. Pass `as_of` for a repeatable stamp."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of)
    return df.select("*", moment.alias(stamp), F.col("_metadata.file_path").alias("_source_file"))


def stamped(df: DataFrame, as_of: datetime | None = None, stamp: str = "_loaded_at") -> DataFrame:
    return df.withColumn(stamp, F.current_timestamp() if as_of is None else F.lit(as_of))


def widen(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append with additive schema drift: unknown columns are kept, missing ones become NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[int, int],
    partitions: int,
    changed_since: tuple[str, datetime] | None = None,
    **options,
) -> DataFrame:
    """Parallel database read; `changed_since=(column, moment)` pulls only newer rows."""
    source = table
    if changed_since is not None:
        column, moment = changed_since
        source = f"(SELECT * FROM {table} WHERE {column} > TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S.%f}') AS changed"
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=source,
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
            **options,
        )
        .load()
    )


def changed_rows(snapshot: DataFrame, column: str, high_water: datetime | None) -> DataFrame:
    """High-watermark pull from a table snapshot; the first pull takes everything."""
    return snapshot if high_water is None else snapshot.where(F.col(column) > F.lit(high_water))


def head_as_json(df: DataFrame, n: int, order: list) -> DataFrame:
    """First n rows, one JSON object per row, NULL fields included."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.orderBy(*order).limit(n).select(body.alias("row_json"))


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def feed_options(servers: str, topic: str, group: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Settings of a broker subscription that starts at the oldest message and survives expired ones."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **(extra or {}),
    }


def state(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of the files of a path (a file or a flat folder); empty where nothing is."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return ()
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(root)))


def put_in_order(spark: SparkSession, path: str, ending: str = ".parquet") -> int:
    """Give the written files of a folder rising times in the order of their names, and return their number.

    A file stream takes files by time, while the tasks of one job write side by
    side. File systems without settable times leave them as they are.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(root) if s.getPath().getName().endswith(ending))
    newest = max((t for _, t in found), default=0)
    for i, (name, _) in enumerate(found):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(root, name), newest - (len(found) - i), -1)
    return len(found)
