"""Order stream: landing, duplicate removal, daily upsert and windowed monitoring."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from merchlake.functions.joins import BROADCAST_LIMIT, flag_members
from merchlake.functions.scalars import order_ts
from merchlake.operators.monitor import windowed_error_rate
from merchlake.sources.schemas import ENVELOPE, ORDER_EVENT


def broker_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Broker messages (value, partition, offset, timestamp)."""
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(spark: SparkSession, path: str, schema: StructType = ENVELOPE, files_per_batch: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """New files of a folder as a stream; each file is picked up once per checkpoint."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def parse_orders(messages: DataFrame, delay: str = "10 minutes", schema: StructType = ORDER_EVENT) -> DataFrame:
    """Messages to bronze order rows. Unreadable JSON keeps its payload beside NULL fields."""
    return (
        messages.select(
            F.col("value").cast("string").alias("raw_payload"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            F.col("timestamp").alias("event_time"),
        )
        .withWatermark("event_time", delay)
        .withColumn("_order", F.from_json("raw_payload", schema))
        .select("_order.*", "raw_payload", "kafka_partition", "kafka_offset", "event_time")
    )


def order_events(messages: DataFrame, delay: str = "3 days", schema: StructType = ORDER_EVENT) -> DataFrame:
    """Messages to orders in event time: `event_time` is the order's own time, with one watermark for all that follows.

    Messages without a readable order id or time have no place in event time and
    are left out here; `parse_orders` and `land` keep them.
    """
    order = F.from_json(F.col("value").cast("string"), schema)
    parsed = messages.select(order.alias("_order")).select("_order.*")
    timed = parsed.withColumn("event_time", order_ts("order_ts").cast("timestamp"))
    return timed.where("order_id IS NOT NULL AND event_time IS NOT NULL").withWatermark("event_time", delay)


def validated_daily_totals(
    orders: DataFrame, customer_ids: DataFrame, product_ids: DataFrame, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """De-duplication, validation against the dimensions and daily totals in one streaming plan with one watermark.

    `orders` comes from `order_events`. Copies of an order carry its id and its
    time, so a copy is either still remembered or behind the watermark: each
    order counts once however far apart its copies arrive. The dimensions are
    static and read anew in each batch. A day comes out once, when the watermark
    has passed its end: accepted orders and their revenue (decimal, hence
    independent of the order of addition), and the rejected ones per rule.
    """
    once = orders.dropDuplicates(["order_id", "event_time"])
    known = flag_members(once, customer_ids, "customer_id", "_customer", limit)
    known = flag_members(known, product_ids, "product_id", "_product", limit)
    priced = F.coalesce(F.col("unit_price") > 0, F.lit(False))
    good = F.col("_customer") & F.col("_product") & priced
    amount = (F.col("unit_price").cast("decimal(18,4)") * F.col("quantity")).cast("decimal(22,4)")
    return (
        known.groupBy(F.window("event_time", "1 day").alias("_day"))
        .agg(
            F.count(F.when(good, 1)).alias("num_orders"),
            F.coalesce(F.sum(F.when(good, amount)), F.lit(0)).cast("decimal(32,4)").alias("gross_revenue"),
            F.count(F.when(~good, 1)).alias("rejected"),
            F.count(F.when(~F.col("_customer"), 1)).alias("unknown_customer"),
            F.count(F.when(~F.col("_product"), 1)).alias("unknown_product"),
            F.count(F.when(~priced, 1)).alias("bad_price"),
        )
        .select(F.to_date("_day.start").alias("order_date"), "num_orders", "gross_revenue", "rejected", "unknown_customer",
                "unknown_product", "bad_price")
    )


def without_repeats(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """First arrival per key while the watermark remembers it."""
    return orders.dropDuplicatesWithinWatermark([key])


def _start(frame: DataFrame, checkpoint: str, interval: str | None):
    writer = frame.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def land(frame: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append to parquet; file sink and checkpoint together give each message exactly once."""
    return _start(frame, checkpoint, interval).outputMode("append").format("parquet").start(path)


def each_batch(frame: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
               interval: str | None = None) -> StreamingQuery:
    return _start(frame, checkpoint, interval).foreachBatch(handle).start()


def daily_totals(orders: DataFrame) -> DataFrame:
    return (
        orders.withColumn("order_date", F.to_date(order_ts("order_ts")))
        .where(F.col("order_date").isNotNull())
        .groupBy("order_date")
        .agg(F.count(F.lit(1)).alias("num_orders"), F.sum(F.expr("quantity * unit_price")).alias("gross_revenue"))
    )


def daily_upsert(table: str, keep: int = 20) -> Callable[[DataFrame, int], None]:
    """Batch handler adding each micro-batch's daily totals to a running table.

    The state after batch n lives in its own folder. A repeated batch finds its
    folder finished and does nothing, so totals are never added twice. The
    table has one row per day, so rewriting it per batch stays cheap; only the
    last `keep` states are kept.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _done(spark, _state(table, batch_id)):
            return
        fresh = daily_totals(batch)
        if batch_id > 0:
            fresh = (
                spark.read.parquet(_state(table, batch_id - 1))
                .unionByName(fresh)
                .groupBy("order_date")
                .agg(F.sum("num_orders").alias("num_orders"), F.sum("gross_revenue").alias("gross_revenue"))
            )
        fresh.write.mode("overwrite").parquet(_state(table, batch_id))
        if batch_id >= keep:
            outdated = spark._jvm.org.apache.hadoop.fs.Path(_state(table, batch_id - keep))
            outdated.getFileSystem(spark._jsc.hadoopConfiguration()).delete(outdated, True)

    return handle


def _state(table: str, batch_id: int) -> str:
    return f"{table.rstrip('/')}/batch={batch_id:09d}"


def _done(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def latest_state(spark: SparkSession, table: str) -> DataFrame:
    """Table as of the last finished batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(path))
    finished = [n for n in names if _done(spark, f"{table}/{n}")]
    return spark.read.parquet(f"{table}/{finished[-1]}")


def split_batches(
    check: Callable[[DataFrame], DataFrame], good: str, bad: str
) -> Callable[[DataFrame, int], None]:
    """Batch handler that validates and writes accepted and rejected rows side by side.

    `check` returns the batch with a `_valid` column; it runs anew per batch,
    so dimension tables it reads are current. Both folders are named after the
    batch and overwritten on repetition.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = check(batch).persist()
        try:
            judged.where("_valid").drop("_valid").write.mode("overwrite").parquet(_state(good, batch_id))
            judged.where("NOT _valid").drop("_valid").write.mode("overwrite").parquet(_state(bad, batch_id))
        finally:
            judged.unpersist()

    return handle


def windowed_errors(messages: DataFrame, delay: str = "10 minutes", width: str = "15 minutes") -> DataFrame:
    """Error rate per event-time window, emitted once the watermark has passed it."""
    return windowed_error_rate(messages.withWatermark("request_timestamp", delay), width)


class LateRows(StreamingQueryListener):
    """Counts the rows a query drops behind its watermark, whole over any number of batches and restarts.

    Spark keeps only the latest progress reports of a query; a listener gets
    every one of them. The count lies beside the checkpoint as (rows of earlier
    batches, last batch, its rows), so a batch that is run again counts once.
    Reports that come before `follow` names the run are kept for it.
    """

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.path = spark, f"{checkpoint.rstrip('/')}-late"
        self.run_id, self.early, self.lock, self.ended = None, [], threading.Lock(), threading.Event()
        self.before, self.batch, self.rows = self._read()

    @property
    def total(self) -> int:
        return self.before + self.rows

    def follow(self, run_id: str) -> None:
        with self.lock:
            self.run_id = run_id
            for report in self.early:
                self._take(*report)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._note(str(progress.runId), progress.batchId, sum(s.numRowsDroppedByWatermark for s in progress.stateOperators))

    def onQueryTerminated(self, event) -> None:
        self._note(str(event.runId), None, 0)

    def _note(self, *report) -> None:
        with self.lock:
            if self.run_id is None:
                self.early.append(report)
            else:
                self._take(*report)

    def _take(self, run_id: str, batch: int | None, rows: int) -> None:
        if run_id != self.run_id:
            return
        if batch is None:
            self.ended.set()
        elif batch > self.batch:
            self.before, self.batch, self.rows = self.before + self.rows, batch, rows
            if rows:
                self._write()
        elif batch == self.batch and rows > self.rows:
            self.rows = rows
            self._write()

    def _folder(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read(self) -> tuple[int, int, int]:
        """The newest state. A state is an empty file named after its numbers, so it is there whole or not at all."""
        path, fs = self._folder()
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        states = [tuple(map(int, n.split("-")[1:])) for n in names if n.startswith("state-")]
        before, batch, rows = max(states, key=lambda s: (s[1], s[2]), default=(0, -1, 0))
        return before, batch, rows

    def _write(self) -> None:
        path, fs = self._folder()
        fs.mkdirs(path)
        name = f"state-{self.before}-{self.batch}-{self.rows}"
        fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(path, name), True).close()
        for old in fs.listStatus(path):
            if old.getPath().getName() != name:
                fs.delete(old.getPath(), False)


def run_counting_late_rows(spark: SparkSession, start: Callable[[], StreamingQuery], checkpoint: str, wait: float = 60.0) -> int:
    """Start a query, wait for its end, and return the late rows of all its runs on this checkpoint."""
    listener = LateRows(spark, checkpoint)
    spark.streams.addListener(listener)
    try:
        query = start()
        listener.follow(str(query.runId))
        query.awaitTermination()
        if not listener.ended.wait(wait):
            raise RuntimeError("the end of the query was not reported")
    finally:
        spark.streams.removeListener(listener)
    return listener.total


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows the query discarded because they were older than its watermark.

    Spark keeps the latest progress reports only (`spark.sql.streaming.numRecentProgressUpdates`).
    A run that has had more is refused, as its count would not be whole.
    """
    reports = query.recentProgress
    if len(reports) >= int(query._jsq.sparkSession().conf().get("spark.sql.streaming.numRecentProgressUpdates", "100")):
        raise RuntimeError("the query has had more progress reports than Spark keeps; raise numRecentProgressUpdates")
    return sum(
        int(state["numRowsDroppedByWatermark"]) for progress in reports for state in progress["stateOperators"]
    )
