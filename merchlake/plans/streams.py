"""Streaming jobs run to the end of the given data; each returns the sink's final content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.functions.joins import estimated_bytes
from merchlake.operators import monitor, quality
from merchlake.plans.registry import CTES, day, moment, query, rounded
from merchlake.session import MB, scratch_path
from merchlake.sources import files, testdata
from merchlake.streaming import orders as stream

SLICES = 4
# Bytes of orders whose messages go to one file of the feed, and the batches in which the files are read.
FEED_BYTES, FEED_BATCHES = 4 * MB, 2

CTES["order_messages"] = """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderkey % 50 = 7 AS broken, copy
    FROM orders JOIN (VALUES (1), (2)) v(copy) ON copy = 1 OR o_orderkey % 3 = 0"""


def _messages(spark: SparkSession, sf_dir: str, ranges: int) -> DataFrame:
    """Broker messages made from the orders: every third one sent twice, some unreadable.

    They lie in ranges of time, which rises with the key; the orders are dealt out, as their messages are far longer.
    """
    orders = testdata.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    orders = orders.repartitionByRange(ranges, "o_orderkey")
    n_parts = testdata.table(spark, sf_dir, "part").count()
    key = F.col("o_orderkey")
    body = F.to_json(
        F.struct(
            key.cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            (key * 7 % (n_parts + n_parts // 10)).cast("string").alias("product_id"),
            F.lit(1).alias("quantity"),
            F.col("o_totalprice").alias("unit_price"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("order_ts"),
        )
    )
    copies = F.when(key % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return orders.withColumn("copy", F.explode(copies)).select(
        F.when(key % 50 == 7, F.concat(F.lit("{broken "), key)).otherwise(body).cast("binary").alias("value"),
        F.pmod(key, F.lit(4)).cast("int").alias("partition"),
        (key * 2 + F.col("copy")).alias("offset"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + key / F.lit(1000))).alias("timestamp"),
    )


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as a stream of files, in time order and in FEED_BATCHES batches; the files grow in number, not in size."""
    path = scratch_path(spark, "feed")
    ranges = max(SLICES, estimated_bytes(testdata.table(spark, sf_dir, "orders")) // FEED_BYTES + 1)
    _messages(spark, sf_dir, ranges).write.parquet(path)
    written = files.put_in_order(spark, path)
    return stream.file_stream(spark, path, files_per_batch=-(-written // FEED_BATCHES))


def _run(query_handle) -> None:
    query_handle.awaitTermination()


@query(
    "stream_landed_orders",
    f"""SELECT count(*) AS n, count(CASE WHEN NOT broken THEN 1 END) AS parsed, count(CASE WHEN broken THEN 1 END) AS broken,
               {rounded("sum(CASE WHEN NOT broken THEN o_totalprice END)")} AS amount FROM order_messages""",
)
def stream_landed_orders(spark, sf):
    out, mark = scratch_path(spark, "bronze"), scratch_path(spark, "mark")
    source = _feed(spark, sf)
    for _ in range(2):  # the second run finds nothing new
        _run(stream.land(stream.parse_orders(source), out, mark))
    landed = spark.read.parquet(out)
    return landed.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("order_id").alias("parsed"),
        F.count(F.when(F.col("order_id").isNull() & F.col("raw_payload").startswith("{broken"), 1)).alias("broken"),
        F.round(F.round(F.sum("unit_price"), 6), 2).alias("amount"),
    )


@query(
    "stream_orders_without_repeats",
    f"""SELECT count(*) AS n, {rounded("sum(o_totalprice)")} AS amount FROM orders WHERE o_orderkey % 50 <> 7""",
)
def stream_orders_without_repeats(spark, sf):
    out, mark = scratch_path(spark, "unique"), scratch_path(spark, "mark")
    rows = stream.parse_orders(_feed(spark, sf), "1 hour")
    _run(stream.land(stream.without_repeats(rows.where("order_id IS NOT NULL")), out, mark))
    return spark.read.parquet(out).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.round(F.sum("unit_price"), 6), 2).alias("amount")
    )


@query(
    "stream_daily_totals",
    f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, count(*) AS num_orders,
               {rounded("sum(o_totalprice)")} AS gross_revenue FROM order_messages WHERE NOT broken GROUP BY 1""",
)
def stream_daily_totals(spark, sf):
    table, mark = scratch_path(spark, "daily"), scratch_path(spark, "mark")
    rows = stream.parse_orders(_feed(spark, sf))
    _run(stream.each_batch(rows, stream.daily_upsert(table), mark))
    totals = stream.latest_state(spark, table)
    return totals.withColumn("gross_revenue", F.round(F.round("gross_revenue", 6), 2))


CTES["numbered_orders"] = """
    SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 40 = 9 THEN 0.0 ELSE o_totalprice END AS price,
           o_custkey + CASE WHEN o_orderkey % 20 = 4 THEN 1000000000 ELSE 0 END AS customer_id,
           o_orderkey * 7 % (SELECT count(*) + count(*) // 10 FROM part) AS product_id
    FROM orders WHERE o_orderkey % 50 <> 7"""
CTES["judged_orders"] = """
    SELECT *, customer_id IN (SELECT c_custkey FROM customer) AS known_customer,
           product_id IN (SELECT p_partkey FROM part) AS known_product FROM numbered_orders"""

DELAY_DAYS, LATE_DAYS, COPY_DAYS = 3, 2, 30


def _order_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages with the day each arrives: every fifth two days late, every third twice, the copy up to 30 days later."""
    orders = testdata.table(spark, sf_dir, "orders")
    n_parts = testdata.table(spark, sf_dir, "part").count()
    key, copy = F.col("o_orderkey"), F.col("copy")
    copies = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    body = F.to_json(
        F.struct(
            key.cast("string").alias("order_id"),
            (F.col("o_custkey") + F.when(key % 20 == 4, 1_000_000_000).otherwise(0)).cast("string").alias("customer_id"),
            (key * 7 % (n_parts + n_parts // 10)).cast("string").alias("product_id"),
            F.lit(1).alias("quantity"),
            F.when(key % 40 == 9, 0.0).otherwise(F.col("o_totalprice")).alias("unit_price"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("order_ts"),
        )
    )
    late = F.when(key % 5 == 2, LATE_DAYS).otherwise(0) + copy * F.when(key % 6 == 0, COPY_DAYS).otherwise(1)
    return orders.withColumn("copy", F.explode(copies)).select(
        F.when(key % 50 == 7, F.concat(F.lit("{broken "), key)).otherwise(body).cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        (key * 2 + copy).cast("long").alias("offset"),
        F.date_add(F.to_date("o_orderdate"), late.cast("int")).cast("timestamp").alias("timestamp"),
    )


@query(
    "stream_validated_daily_totals",
    f"""SELECT {day("o_orderdate")} AS order_date, count(CASE WHEN good THEN 1 END) AS num_orders,
               CAST(coalesce(sum(CASE WHEN good THEN CAST(price AS DECIMAL(18,4)) END), 0) AS DOUBLE) AS gross_revenue,
               count(CASE WHEN NOT good THEN 1 END) AS rejected, count(CASE WHEN NOT known_customer THEN 1 END) AS unknown_customer,
               count(CASE WHEN NOT known_product THEN 1 END) AS unknown_product, count(CASE WHEN price <= 0 THEN 1 END) AS bad_price
        FROM (SELECT *, known_customer AND known_product AND price > 0 AS good FROM judged_orders)
        GROUP BY o_orderdate
        HAVING CAST(o_orderdate AS TIMESTAMP) + INTERVAL {DELAY_DAYS + 1} DAY <= (SELECT CAST(max(o_orderdate) AS TIMESTAMP) FROM numbered_orders)""",
)
def stream_validated_daily_totals(spark, sf):
    """De-duplication, validation and totals in one stream, stopped and started anew for every slice of arrivals."""
    source, out, mark = (scratch_path(spark, n) for n in ("deliveries", "totals", "mark"))
    messages = _order_deliveries(spark, sf)
    first, last = testdata.table(spark, sf, "orders").agg(
        F.min(F.to_date("o_orderdate")).cast("timestamp"), F.max(F.to_date("o_orderdate")).cast("timestamp")
    ).first()
    borders = [first + i * (last - first) / SLICES for i in range(1, SLICES)]
    slice_no = sum(((F.col("timestamp") >= F.lit(b)).cast("int") for b in borders), F.lit(0))
    customers = testdata.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"))
    products = testdata.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id"))
    for i in range(SLICES):
        messages.where(slice_no == i).write.mode("append").parquet(source)
        events = stream.order_events(stream.file_stream(spark, source), f"{DELAY_DAYS} days")
        _run(stream.land(stream.validated_daily_totals(events, customers, products), out, mark))
    return spark.read.parquet(out).withColumn("gross_revenue", F.col("gross_revenue").cast("double"))


@query(
    "stream_quality_split",
    """SELECT o_custkey % 2 = 0 AND NOT broken AND o_orderkey * 7 % (SELECT count(*) + count(*) // 10 FROM part)
              IN (SELECT p_partkey FROM part) AS accepted, count(*) AS n FROM order_messages GROUP BY 1""",
)
def stream_quality_split(spark, sf):
    good, bad, mark = (scratch_path(spark, n) for n in ("good", "bad", "mark"))

    def check(batch: DataFrame) -> DataFrame:
        known = testdata.table(batch.sparkSession, sf, "customer").where("c_custkey % 2 = 0")
        return quality.check_orders(
            batch,
            known.select(F.col("c_custkey").cast("string").alias("customer_id")),
            testdata.table(batch.sparkSession, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id")),
        ).drop("_failed_rules")

    rows = stream.parse_orders(_feed(spark, sf))
    _run(stream.each_batch(rows, stream.split_batches(check, good, bad), mark))
    return (
        spark.read.parquet(good).select(F.lit(True).alias("accepted"))
        .unionByName(spark.read.parquet(bad).select(F.lit(False).alias("accepted")))
        .groupBy("accepted")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "stream_error_windows",
    f"""SELECT {moment("w")} AS window_start, count(*) AS total,
               count(CASE WHEN status_code >= 400 THEN 1 END) AS errors,
               round(count(CASE WHEN status_code >= 400 THEN 1 END) / count(*), 4) AS error_rate
        FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, request_timestamp) AS w FROM chat_log)
        WHERE w + INTERVAL 15 MINUTE <= (SELECT max(request_timestamp) FROM chat_log) - INTERVAL 10 MINUTE
        GROUP BY w""",
)
def stream_error_windows(spark, sf):
    """Only windows behind the watermark come out, as append mode demands."""
    source, out, mark = (scratch_path(spark, n) for n in ("chat", "windows", "mark"))
    log = testdata.chat_log(spark, sf).withColumn("request_timestamp", F.col("request_timestamp").cast("timestamp"))
    log.repartitionByRange(4, "request_timestamp").write.parquet(source)
    rows = stream.file_stream(spark, source, log.schema)
    _run(stream.land(stream.windowed_errors(rows), out, mark))
    return spark.read.parquet(out)


LATE_MINUTES = 40

CTES["arrivals"] = f"""
    SELECT event_id, ts, CAST(floor(epoch_us(ts + CASE WHEN event_id % 10 = 3 THEN INTERVAL {LATE_MINUTES} MINUTE
                                      ELSE INTERVAL 0 MINUTE END - (SELECT min(ts) FROM events))
               / ((SELECT epoch_us(max(ts) - min(ts)) FROM events) / {SLICES}.0)) AS BIGINT) AS slice FROM events"""
CTES["slice_marks"] = """
    SELECT DISTINCT slice, (SELECT max(ts) FROM arrivals b WHERE b.slice < a.slice) AS seen FROM arrivals a"""


@query(
    "stream_late_rows",
    """SELECT d.delay, count(CASE WHEN seen IS NULL OR ts > seen - to_minutes(d.delay) THEN 1 END) AS landed,
              count(CASE WHEN ts <= seen - to_minutes(d.delay) THEN 1 END) AS dropped
       FROM arrivals JOIN slice_marks USING (slice), (VALUES (10), (60)) d(delay) GROUP BY 1""",
)
def stream_late_rows(spark, sf):
    """Completeness under a short and a long watermark: every tenth event arrives 40 minutes late.

    Events arrive in slices of time; each slice is one run of the stream.
    """
    events = testdata.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    width = (last - first) / SLICES
    late = F.when(F.col("event_id") % 10 == 3, F.expr(f"INTERVAL {LATE_MINUTES} MINUTES")).otherwise(
        F.expr("INTERVAL 0 MINUTES")
    )
    arrived = events.withColumn("arrival", F.col("ts") + late)
    source = scratch_path(spark, "arrivals")
    delays = {10: (scratch_path(spark, "short"), scratch_path(spark, "mark")),
              60: (scratch_path(spark, "long"), scratch_path(spark, "mark"))}
    dropped = dict.fromkeys(delays, 0)
    for i in range(SLICES + 1):
        after = F.col("arrival") >= F.lit(first + i * width)
        before = F.col("arrival") < F.lit(first + (i + 1) * width)
        arrived.where(after & before).select("event_id", "ts").write.mode("append").parquet(source)
        for delay, (out, mark) in delays.items():
            rows = stream.file_stream(spark, source, events.schema).withWatermark("ts", f"{delay} minutes")
            unique = stream.without_repeats(rows, "event_id")
            dropped[delay] = stream.run_counting_late_rows(spark, lambda u=unique, o=out, m=mark: stream.land(u, o, m), mark)
    parts = [
        spark.read.parquet(out).agg(F.count(F.lit(1)).alias("landed")).select(
            F.lit(delay).alias("delay"), "landed", F.lit(dropped[delay]).alias("dropped")
        )
        for delay, (out, _) in delays.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "stream_chat_log_hours",
    f"""SELECT {moment("w")} AS window_start, count(*) AS total, count(CASE WHEN status_code >= 400 THEN 1 END) AS errors,
               round(count(CASE WHEN status_code >= 400 THEN 1 END) / count(*), 4) AS error_rate
        FROM (SELECT *, date_trunc('hour', request_timestamp) AS w FROM chat_log) GROUP BY w""",
)
def stream_chat_log_hours(spark, sf):
    """Hourly volume and errors of the chat log as a stream in complete mode."""
    source, mark = scratch_path(spark, "chat-log"), scratch_path(spark, "mark")
    table = scratch_path(spark, "hours")
    log = testdata.chat_log(spark, sf).withColumn("request_timestamp", F.col("request_timestamp").cast("timestamp"))
    log.write.parquet(source)
    hourly = monitor.windowed_error_rate(stream.file_stream(spark, source, log.schema), "1 hour")

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id:09d}")

    handle = (
        hourly.writeStream.outputMode("complete").option("checkpointLocation", mark).trigger(availableNow=True)
        .foreachBatch(replace).start()
    )
    _run(handle)
    return stream.latest_state(spark, table)
