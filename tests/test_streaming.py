import json
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from merchlake.session import scratch_path
from merchlake.streaming import orders as stream

BASE = datetime(2024, 1, 1, 12)


def message(i, minutes=0, price=10.0, broken=False, day="2024-01-01"):
    body = {"order_id": f"o{i}", "customer_id": "c", "product_id": "p", "quantity": 2, "unit_price": price,
            "order_ts": f"{day}T10:00:00"}
    text = "{oops" if broken else json.dumps(body)
    return (bytearray(text.encode()), 0, i, BASE + timedelta(minutes=minutes))


def deliver(spark, path, *messages):
    frame = spark.createDataFrame(list(messages), stream.ENVELOPE)
    frame.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def paths(spark):
    return lambda *names: [scratch_path(spark, n) for n in names]


def test_landing_keeps_broken_messages_once(spark, paths):
    feed, out, mark = paths("feed", "out", "mark")
    deliver(spark, feed, message(1), message(2, broken=True))

    def run():
        stream.land(stream.parse_orders(stream.file_stream(spark, feed)), out, mark).awaitTermination()

    run()
    run()
    assert rows(spark.read.parquet(out).select("order_id", "raw_payload").where("order_id IS NULL")) == [(None, "{oops")]
    deliver(spark, feed, message(3))
    run()
    assert spark.read.parquet(out).count() == 3


def test_repeats_and_late_rows(spark, paths):
    """Late rows pass until a later batch runs under the moved watermark."""
    results = {}
    for delay in ("10 minutes", "60 minutes"):
        feed, out, mark = paths("feed", "out", "mark")
        dropped = 0
        for batch in ([message(1), message(1)], [message(2, 60), message(1, 1)], [message(3, 20), message(4, 61)]):
            deliver(spark, feed, *batch)
            rows_ = stream.parse_orders(stream.file_stream(spark, feed), delay)
            handle = stream.land(stream.without_repeats(rows_), out, mark)
            handle.awaitTermination()
            dropped += stream.dropped_late_rows(handle)
        landed = sorted(r["order_id"] for r in spark.read.parquet(out).collect())
        results[delay] = (landed, dropped)
    assert results["60 minutes"] == (["o1", "o2", "o3", "o4"], 0)
    assert results["10 minutes"] == (["o1", "o2", "o4"], 1)


def test_daily_upsert_adds_up_and_is_repeatable(spark, paths):
    feed, table, mark = paths("feed", "table", "mark")
    for batch in ([message(1), message(2, day="2024-01-02")], [message(3, price=5.0)]):
        deliver(spark, feed, *batch)
        handle = stream.each_batch(stream.parse_orders(stream.file_stream(spark, feed)), stream.daily_upsert(table), mark)
        handle.awaitTermination()
    wanted = [("2024-01-01", 2, 30.0), ("2024-01-02", 1, 20.0)]
    state = stream.latest_state(spark, table).select(F.col("order_date").cast("string"), "num_orders", "gross_revenue")
    assert rows(state) == wanted
    batches = spark.read.parquet(table).select("batch").distinct().count()
    replay = spark.createDataFrame([("o9", 1, 1.0, "2024-01-01T00:00:00")], "order_id STRING, quantity INT, unit_price DOUBLE, order_ts STRING")
    stream.daily_upsert(table)(replay, batches - 1)
    assert rows(stream.latest_state(spark, table).select(F.col("order_date").cast("string"), "num_orders", "gross_revenue")) == wanted


def test_quality_split_in_batches(spark, paths):
    feed, good, bad, mark = paths("feed", "good", "bad", "mark")
    deliver(spark, feed, message(1), message(2, price=0.0), message(3, broken=True))
    check = lambda b: b.withColumn("_valid", F.coalesce(F.col("unit_price") > 0, F.lit(False)))
    stream.each_batch(
        stream.parse_orders(stream.file_stream(spark, feed)), stream.split_batches(check, good, bad), mark
    ).awaitTermination()
    assert spark.read.parquet(good).count() == 1
    assert spark.read.parquet(bad).count() == 2


def test_error_windows(spark, paths):
    feed, out, mark = paths("feed", "out", "mark")
    log = spark.createDataFrame(
        [(BASE, 200), (BASE + timedelta(minutes=1), 500), (BASE + timedelta(hours=2), 200)],
        "request_timestamp TIMESTAMP, status_code INT",
    )
    log.write.parquet(feed)
    stream.land(stream.windowed_errors(stream.file_stream(spark, feed, log.schema)), out, mark).awaitTermination()
    assert rows(spark.read.parquet(out)) == [(BASE, 2, 1, 0.5)]


def order_message(i, order, minutes, customer="c", product="p", price=10.0, quantity=2):
    body = {"order_id": order, "customer_id": customer, "product_id": product, "quantity": quantity, "unit_price": price,
            "order_ts": (BASE + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S") if minutes is not None else None}
    return (bytearray(json.dumps(body).encode()), 0, i, BASE)


def test_chain_counts_each_valid_order_once(spark, paths):
    """Out-of-order, repeated and late files with a restart before each: totals equal those of the distinct valid orders."""
    feed, out, mark = paths("feed", "out", "mark")
    hour, day = 60, 24 * 60
    batches = [
        [order_message(1, "a", 0), order_message(2, "a", 0), order_message(3, "b", 2 * hour, price=0.1, quantity=3)],
        [order_message(4, "late", -3 * hour), order_message(5, "c", day), order_message(6, "a", 0), order_message(7, "x", 1, product="?")],
        [order_message(8, "d", day + hour, customer="?", product="?"), order_message(9, "e", day + 1, price=0.0),
         order_message(10, None, day), order_message(11, "n", None), (bytearray(b"{oops"), 0, 12, BASE)],
        [order_message(13, "far", 10 * day)],
        # All of these are behind the watermark: copies, and one that comes too late.
        [order_message(14, "a", 0), order_message(15, "c", day), order_message(16, "too late", 5 * hour), order_message(17, "end", 20 * day)],
    ]
    people = spark.createDataFrame([("c",), ("c",), (None,)], "customer_id STRING")
    goods = spark.createDataFrame([("p",)], "product_id STRING")
    late = []
    for batch in batches:
        deliver(spark, feed, *batch)
        events = stream.order_events(stream.file_stream(spark, feed), "1 day")
        totals = stream.validated_daily_totals(events, people, goods)
        late.append(stream.run_counting_late_rows(spark, lambda t=totals: stream.land(t, out, mark), mark))
    got = sorted(tuple(map(str, r)) for r in spark.read.parquet(out).collect())
    assert got == [
        ("2024-01-01", "3", "40.3000", "1", "0", "1", "0"),
        ("2024-01-02", "1", "20.0000", "2", "1", "1", "1"),
        ("2024-01-11", "1", "20.0000", "0", "0", "0", "0"),
    ]
    assert late == [0, 0, 0, 0, 3]


def test_chain_without_broadcast(spark, paths):
    feed, out, mark = paths("feed", "out", "mark")
    deliver(spark, feed, *[order_message(i, f"o{i}", i, customer=f"c{i % 3}") for i in range(40)], order_message(99, "end", 10**5))
    people = spark.createDataFrame([("c0",), ("c1",)], "customer_id STRING")
    goods = spark.createDataFrame([("p",)], "product_id STRING")
    totals = stream.validated_daily_totals(stream.order_events(stream.file_stream(spark, feed)), people, goods, limit=0)
    stream.land(totals, out, mark).awaitTermination()
    assert [(r["num_orders"], r["unknown_customer"]) for r in spark.read.parquet(out).collect()] == [(27, 13)]


def test_late_rows_of_many_batches_are_counted_whole(spark, paths):
    """More batches than Spark keeps reports of, with a restart between."""
    feed, out, mark = paths("feed", "out", "mark")
    schema = "ts TIMESTAMP, k INT"
    late, kept, total = 0, spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"), 0
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        for run in range(2):
            for i in range(run * 20, run * 20 + 20):
                rows_ = [(BASE + timedelta(hours=i), i)] + [(BASE - timedelta(days=1), 1000 + i)] * (i % 3)
                spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(feed)
                late += i % 3 if i > 1 else 0  # a batch is measured by the watermark that the one before it had

            def start():
                frame = stream.file_stream(spark, feed, spark.read.parquet(feed).schema, files_per_batch=1)
                return stream.land(stream.without_repeats(frame.withWatermark("ts", "10 minutes"), "k"), out, mark)

            total = stream.run_counting_late_rows(spark, start, mark)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert total == late > 30


def test_late_rows_of_a_repeated_batch_count_once(spark, paths):
    (mark,) = paths("mark")
    first = stream.LateRows(spark, mark)
    first.follow("r")
    for batch in range(300):
        first._note("r", batch, batch % 2)
    again = stream.LateRows(spark, mark)
    again._note("s", 299, 1)
    again._note("other", 300, 50)
    again.follow("s")
    again._note("s", 300, 4)
    assert (first.total, again.total, stream.LateRows(spark, mark).total) == (150, 154, 154)
