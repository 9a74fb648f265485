import random

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from merchlake.functions import joins, ordering


def facts(spark, n=2000):
    """A third of the rows share one key, some keys are NULL."""
    rng = random.Random(3)
    data = [(i, "hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{rng.randrange(50)}") for i in range(n)]
    return spark.createDataFrame(data, "id INT, k STRING")


def dim(spark):
    return spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)], "k STRING, v INT")


def test_all_join_routes_agree(spark):
    f, d = facts(spark), dim(spark)
    for how in ("left", "inner", "left_semi", "left_anti"):
        wanted = rows(f.join(d, "k", how).select("id"))
        for options in ({}, {"limit": -1}, {"limit": -1, "hot": ["hot"], "salts": 4}):
            assert rows(joins.spread_join(f, d, "k", how, **options).select("id")) == wanted, (how, options)


def test_hot_key_is_spread(spark):
    joined = joins.spread_join(facts(spark), dim(spark), "k", limit=-1, hot=["hot"], salts=16)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_hot_keys_are_found(spark):
    assert joins.hot_keys(facts(spark, 20000), "k", share=0.1, fraction=0.5) == ["hot"]


def test_flag_members_is_never_null(spark):
    for limit in (joins.BROADCAST_LIMIT, -1):
        flagged = joins.flag_members(facts(spark), dim(spark).union(dim(spark)).select("k"), "k", "known", limit)
        assert flagged.count() == 2000
        assert flagged.where("known IS NULL").count() == 0
        assert flagged.where("k IS NULL AND known").count() == 0
        assert flagged.where("k = 'hot' AND NOT known").count() == 0


def test_broadcast_only_below_limit(spark):
    d = spark.range(10)
    assert "broadcast" in joins.checked_broadcast(d)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in joins.checked_broadcast(d, 1)._jdf.queryExecution().analyzed().toString().lower()


def test_running_weight_over_one_big_group(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([("a" if v % 5 else "b", v, v % 7) for v in values], "g STRING, v INT, w INT")
    got = {r["v"]: (r["before"], r["group_total"]) for r in
           ordering.running_weight(df, ["g"], ["v"], "w", pieces=7).collect()}
    for v in range(500):
        same = [x for x in range(500) if bool(x % 5) == bool(v % 5)]
        assert got[v] == (sum(x % 7 for x in same if x < v), sum(x % 7 for x in same))


def test_running_weight_descending(spark):
    df = spark.range(100).withColumn("w", F.lit(1))
    got = ordering.running_weight(df, [], [F.desc("id")], "w", pieces=5).collect()
    assert all(r["before"] == 99 - r["id"] for r in got)


def test_tile_matches_ntile(spark):
    for n in (3, 5, 13, 100):
        df = spark.range(n).select((F.col("id") + 1).alias("rn"), F.lit(n).cast("bigint").alias("n"))
        got = [r[0] for r in df.orderBy("rn").select(ordering.tile(F.col("rn"), F.col("n"), 5)).collect()]
        wanted = [r[0] for r in df.selectExpr("ntile(5) OVER (ORDER BY rn) AS t", "rn").orderBy("rn").collect()]
        assert got == wanted


def test_neighbours_cross_range_borders(spark):
    df = spark.createDataFrame([("a", i, i * 10) for i in range(200)] + [("b", 0, 5)], "g STRING, i INT, x INT")
    got = ordering.neighbours(df, ["g"], ["i"], {"p": "x"}, {"n": "x"}, pieces=9).collect()
    for r in got:
        if r["g"] == "b":
            assert (r["p"], r["n"]) == (None, None)
        else:
            assert r["p"] == (r["x"] - 10 if r["i"] else None)
            assert r["n"] == (r["x"] + 10 if r["i"] < 199 else None)


def test_hot_partition_is_split_at_run_time(spark, tmp_path):
    """A big key set of unknown hot keys: the join itself gets split, without listing them."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    data = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    keys = data.select("k").distinct()
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        flagged = joins.flag_members(data, keys, "k", "known", limit=-1)
        assert flagged.where("known").count() == 60000
        flagged.write.format("noop").mode("overwrite").save()
        flagged.collect()
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_neighbours_of_light_and_heavy_groups_agree(spark):
    data = [("a" if v % 3 else None if v % 2 else f"k{v % 12}", v, v * 10) for v in range(600)]
    random.Random(2).shuffle(data)
    df = spark.createDataFrame(data, "g STRING, i INT, x INT")
    wanted = rows(ordering.neighbours(df, ["g"], ["i"], {"p": "x"}, {"n": "x"}, pieces=5))
    heavy = ordering.heavy_buckets(df, ["g"], most=90)
    assert len(heavy) == 2  # of "a" and of NULL
    for some in (heavy, heavy[:1], []):
        assert rows(ordering.neighbours(df, ["g"], ["i"], {"p": "x"}, {"n": "x"}, heavy=some)) == wanted


def test_neighbours_of_light_groups_take_one_shuffle(spark):
    df = spark.createDataFrame([(f"k{v % 50}", v, v) for v in range(500)], "g STRING, i INT, x INT")
    before = ordering.neighbours(df, ["g"], ["i"], {"p": "x"})
    after = ordering.neighbours(before.where("p IS NULL OR p <> x"), ["g"], ["i"], following={"n": "x"})
    assert exchanges(after) == 1


def test_joined_frames_are_cut_into_the_usual_number_of_ranges(spark, tmp_path):
    """The estimate of a join is the product of its sides; the ranges follow what is read."""
    spark.range(20_000).selectExpr("id", "id % 7 AS g").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    other = t.withColumnsRenamed({"id": "_id", "g": "_g"}).where("_id < 5")
    joined = t.join(other, t.id == other._id, "left")
    assert joins.estimated_bytes(joined) > 64 * ordering.RANGE_BYTES
    cut = ordering.cut_into_ranges(joined, ["g"], ["id"])
    assert cut.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert cut.count() == 20_000
