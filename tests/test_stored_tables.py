"""Hash trees and tables by period: what is read and written grows with the changes."""

import random
from datetime import date
from pathlib import Path

from conftest import rows
from pyspark.sql import functions as F

from merchlake.session import scratch_path
from merchlake.sources import hashtree, periods, snapshots

SIZE = {"leaves": 4096, "folders": 16}


def snapshot(spark, changed=(), gone=(), new=()):
    base = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 97).alias("a"), F.lit(None).cast("string").alias("b"))
    base = base.withColumn("b", F.when(F.col("k").isin(list(changed) or [-1]), "x")).where(~F.col("k").isin(list(gone) or [-1]))
    return base.unionByName(spark.createDataFrame([(k, 0, "n") for k in new], base.schema)) if new else base


def test_changes_are_read_from_differing_ranges_only(spark):
    rng = random.Random(2)
    picks = rng.sample(range(20_000), 60)
    before = snapshot(spark)
    paths = [scratch_path(spark, "tree") for _ in range(4)]
    versions = [before, snapshot(spark, picks[:3], picks[3:5], [30_000]), snapshot(spark, picks[:50], picks[50:]), snapshot(spark)]
    for path, df in zip(paths, versions, strict=True):
        hashtree.write(df, path, ["k"], **SIZE)
    read = []
    for path, df in zip(paths[1:], versions[1:], strict=True):
        leaves = hashtree.differing_leaves(spark, paths[0], path, SIZE["leaves"])
        read.append(hashtree.rows_of_leaves(spark, path, leaves, **SIZE).count())
        got = hashtree.changes_between(spark, paths[0], path, ["k"], **SIZE)
        assert rows(got) == rows(snapshots.changes(before, df, ["k"]))
    assert read[2] == 0 and 0 < read[0] < 60 and read[0] < read[1] < 600


def test_swapped_values_and_repeated_rows_are_seen(spark):
    paths = [scratch_path(spark, "tree") for _ in range(3)]
    data = [[(1, None, "a"), (2, "b", "c")], [(1, "a", None), (2, "b", "c")], []]
    for path, some in zip(paths, data, strict=True):
        hashtree.write(spark.createDataFrame(some, "k int, x string, y string"), path, ["k"], leaves=16, folders=4)
    assert len(hashtree.differing_leaves(spark, paths[0], paths[1], 16)) == 1
    assert len(hashtree.differing_leaves(spark, paths[0], paths[2], 16)) in (1, 2)


def files(table):
    return {str(p.relative_to(table)) for p in Path(table).rglob("*.parquet")}


def test_loads_touch_only_their_periods(spark, tmp_path):
    table = str(tmp_path / "days")
    days = spark.range(40).select("id", F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 4).cast("int")).alias("day"))
    periods.append(days, table, "day")
    first = files(table)
    periods.append(days.where("id < 2"), table, "day")
    second = files(table)
    assert first < second and {f.split("/")[0] for f in second - first} == {"day=2024-01-01", "day=2024-01-02"}
    periods.replace(days.where("id = 1"), table, "day")
    third = files(table)
    assert {f.split("/")[0] for f in second - third} == {"day=2024-01-02"}
    assert rows(spark.read.parquet(table).groupBy("day").count()) == [
        (date(2024, 1, 1), 11), (date(2024, 1, 2), 1), (date(2024, 1, 3), 10), (date(2024, 1, 4), 10)]
    assert periods.purge(spark, table, "day", date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    assert files(table) == {f for f in third if f > "day=2024-01-03"}
    assert periods.purge(spark, table, "day", date(2024, 1, 3)) == []


def test_facts_are_stored_tightly(spark):
    from conftest import SMALL

    from merchlake.plans.commerce import Lake

    lake = Lake(spark, SMALL)
    for fact in (lake.orders, lake.returns):
        assert fact.inputFiles() and all(".zstd.parquet" in f for f in fact.inputFiles())
