from pyspark.sql import functions as F

from merchlake.plans import catalogue, streams
from merchlake.session import scratch_path


def made(spark, tmp_path, n):
    """Orders over many hours of message time, in no order, and the dimensions they need."""
    orders = spark.range(n).selectExpr(
        "id * 1000 AS o_orderkey", "id % 100 AS o_custkey", "CAST(id % 90 AS DOUBLE) AS o_totalprice",
        "TIMESTAMP '1996-01-01' + make_dt_interval(CAST(id % 300 AS INT)) AS o_orderdate",
    )
    orders.orderBy(F.xxhash64("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(100).selectExpr("id AS c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(50).selectExpr("id AS p_partkey").write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def test_feed_files_grow_in_number_and_come_in_time_order(spark, tmp_path, monkeypatch):
    sf = made(spark, tmp_path, 20_000)
    monkeypatch.setattr(streams, "FEED_BYTES", 10_000)
    feed = streams._feed(spark, sf).withColumn("_file", F.input_file_name())
    out, mark = scratch_path(spark, "out"), scratch_path(spark, "mark")

    def keep(batch, batch_id):
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(out)

    feed.writeStream.option("checkpointLocation", mark).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    read = spark.read.parquet(out)
    sizes = [r["count"] for r in read.groupBy("_file").count().collect()]
    assert len(sizes) > streams.SLICES and max(sizes) < sum(sizes) / streams.SLICES
    first, second = (read.where(F.col("_batch") == i).agg(F.min("timestamp"), F.max("timestamp")).first() for i in (0, 1))
    assert first[1] < second[0] and read.agg(F.max("_batch")).first()[0] == 1


def test_no_order_of_a_long_feed_is_late(spark, tmp_path, monkeypatch):
    sf = made(spark, tmp_path, 20_000)
    monkeypatch.setattr(streams, "FEED_BYTES", 10_000)
    got = catalogue.QUERIES["stream_orders_without_repeats"](spark, sf).first()
    assert got["n"] == spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey % 50 <> 7").count()
    split = {r["accepted"]: r["n"] for r in catalogue.QUERIES["stream_quality_split"](spark, sf).collect()}
    assert sum(split.values()) == 20_000 + len([k for k in range(20_000) if k * 1000 % 3 == 0])
