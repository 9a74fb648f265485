"""Contiguous shards of nearly equal byte size, cut from global prefix sums.

Rows are put in the order (id, size, checksum of the text) by a range
partitioning. Each range is summed; the running total of these few sums gives
every range its offset, and a running sum inside the range gives every row its
place in the whole. A shard is the part of the total that the middle of the
row falls into, so shards are contiguous and differ from the target by less
than one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlake.llm.common import kept

ROWS_PER_RANGE = 2_000_000


def byte_shards(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    overhead: int = 8,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 length of the text (NULL: 0) plus `overhead`; slot counts
    from 0 without gaps inside each shard. NULL ids come first. Repeated rows
    are kept and take neighbouring slots; which of several equal rows takes
    which slot is of no consequence. An empty table gives an empty result. Other
    input columns, whatever their names, are not read.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = docs.sparkSession
    content = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        (F.octet_length(content).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    order = ["doc_id", "size", "text_crc32"]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // rows_per_range + 1)
    cut = kept(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))

    totals = cut.groupBy("_range").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(everything).alias("_total"),
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = cut.select(
        "*",
        (F.sum("size").over(inside) - F.col("size")).alias("_bytes_in"),
        (F.count(F.lit(1)).over(inside) - 1).alias("_rows_in"),
    ).join(offsets, "_range")
    middle = 2 * (F.col("_bytes_before") + F.col("_bytes_in")) + F.col("size")
    placed = placed.select(
        *order,
        (F.col("_rows_before") + F.col("_rows_in")).alias("_row"),
        F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / (2 * F.col("_total")))).cast("int").alias("shard"),
    )
    # At most `shards` rows, hence safe to broadcast.
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first")).withColumnRenamed("shard", "_shard")
    return placed.join(F.broadcast(firsts), F.col("shard") == F.col("_shard")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_row") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
