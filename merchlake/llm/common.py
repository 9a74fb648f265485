"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.session import scratch_root

# Rows go back from Python in pieces of about this many bytes.
FLUSH_BYTES = 8 * 1024 * 1024


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there, so that lost executors cost no rerun."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def text_of(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def key_crc(column: str) -> Column:
    """crc32 of an id as text; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch as Python values, one at a time, so that a batch of long texts is not held twice."""
    columns = batch.columns
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


class Rows:
    """Collects result rows inside a task and hands them on as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.columns: list[list] = [[] for _ in schema]
        self.size = 0

    def add(self, row: tuple, size: int = 64) -> Iterator[pa.RecordBatch]:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)
        self.size += size
        if self.size >= FLUSH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.columns and self.columns[0]:
            arrays = [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
        self.columns = [[] for _ in self.schema]
        self.size = 0
