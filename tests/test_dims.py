from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from merchlake.operators import dims
from merchlake.session import scratch_path
from merchlake.sources import files, snapshots

D1, D2, D3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
END = datetime(9999, 12, 31)
PEOPLE = "customer_id STRING, first_name STRING, last_name STRING, email STRING, city STRING, country STRING, phone STRING"


def people(spark, *data):
    return spark.createDataFrame([(k, "f", "l", e, c, "NL", p) for k, e, c, p in data], PEOPLE)


def state(df):
    return rows(df.select("customer_id", "email", "is_current", "valid_from", "valid_to"))


def test_scd2_life_cycle(spark):
    first = dims.scd2_start(people(spark, ("same", "a", "x", None), ("moves", "b", "x", None), ("gone", "c", "x", None)), D1)
    second = dims.scd2_apply(
        first, people(spark, ("same", "a", "x", None), ("moves", "b2", "x", None), ("new", "n", "x", None)), D2
    )
    wanted = [
        ("gone", "c", True, D1, END),
        ("moves", "b", False, D1, D2),
        ("moves", "b2", True, D2, END),
        ("new", "n", True, D2, END),
        ("same", "a", True, D1, END),
    ]
    assert state(second) == sorted(wanted, key=repr)
    again = dims.scd2_apply(second, people(spark, ("moves", "b2", "x", None)), D3)
    assert state(again) == state(second)
    assert dims.scd2_problems(second, "customer_id", pieces=3).count() == 0
    assert [r["customer_id"] for r in dims.unseen(people(spark, ("x", "e", "c", None)), second, "customer_id").collect()] == ["x"]


def test_value_moving_between_nullable_columns_is_a_change(spark):
    before, after = people(spark, ("k", None, "x", "1")), people(spark, ("k", "1", "x", None))
    tracked = ["email", "phone"]
    strict = dims.scd2_apply(dims.scd2_start(before, D1, tracked=tracked), after, D2, tracked=tracked)
    loose = dims.scd2_apply(
        dims.scd2_start(before, D1, tracked=tracked, null_token=None), after, D2, tracked=tracked, null_token=None
    )
    assert strict.count() == 2
    assert loose.count() == 1


def test_scd1_upsert(spark):
    schema = "product_id STRING, unit_price DOUBLE"
    start = dims.scd1_start(spark.createDataFrame([("a", 1.0), ("gone", 2.0)], schema), D1)
    merged = dims.scd1_apply(start, spark.createDataFrame([("a", 1.5), ("new", None)], schema), D2)
    assert rows(merged) == [("a", 1.5, D2), ("gone", 2.0, D1), ("new", None, D2)]


def test_versions_from_unordered_change_log(spark):
    log = spark.createDataFrame(
        [("k", 3, "B", D3), ("k", 1, "A", D1), ("k", 2, "A", D2), ("j", 1, None, D1)],
        "key STRING, seq INT, v STRING, at TIMESTAMP",
    )
    got = dims.scd2_from_changes(log, "key", ["seq"], ["v"], "at", pieces=3)
    assert rows(got.select("key", "v", "is_current", "valid_from", "valid_to")) == sorted(
        [("j", None, True, D1, END), ("k", "A", False, D1, D3), ("k", "B", True, D3, END)], key=repr
    )


def test_integrity_report_finds_faults(spark):
    bad = spark.createDataFrame(
        [("two", True, D1, END), ("two", True, D2, END), ("none", False, D1, D2), ("ok", True, D1, END)],
        "k STRING, is_current BOOLEAN, valid_from TIMESTAMP, valid_to TIMESTAMP",
    )
    assert rows(dims.scd2_problems(bad, "k", pieces=2)) == [("none", 0, 0), ("two", 2, 1)]


@pytest.mark.parametrize("options", [{}, {"limit": -1}, {"limit": -1, "hot": ["k"]}])
def test_point_in_time_join_uses_the_old_version(spark, options):
    dim = spark.createDataFrame(
        [("k", "old", D1, D2), ("k", "new", D2, END)], "k STRING, seg STRING, valid_from TIMESTAMP, valid_to TIMESTAMP"
    )
    facts = spark.createDataFrame(
        [(1, "k", datetime(2024, 1, 15)), (2, "k", D2), (3, "k", datetime(2023, 1, 1)), (4, "z", D2), (5, None, D2)],
        "id INT, k STRING, at TIMESTAMP",
    )
    got = {r["id"]: r["seg"] for r in dims.point_in_time_join(facts, dim, "k", "at", ["seg"], **options).collect()}
    assert got == {1: "old", 2: "new", 3: None, 4: None, 5: None}


def test_enrich_on_composite_keys(spark):
    facts = spark.createDataFrame([(1, "a", "x"), (2, "a", "z")], "id INT, cat STRING, sub STRING")
    ref = spark.createDataFrame([("a", "x", "AX")], "category STRING, sub_category STRING, name STRING")
    got = dims.enrich(facts, ref, {"cat": "category", "sub": "sub_category"})
    assert got.columns == ["id", "cat", "sub", "name"]
    assert rows(got) == [(1, "a", "x", "AX"), (2, "a", "z", None)]


def test_change_feed(spark):
    schema = "k INT, v STRING"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], schema)
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (5, "e")], schema)
    assert rows(snapshots.changes(old, new, ["k"])) == sorted(
        [(2, "b", "update_preimage"), (2, "B", "update_postimage"), (4, "d", "delete"), (5, "e", "insert")], key=repr
    )


def test_snapshot_versions_guard_and_time_travel(spark):
    table = scratch_path(spark, "t")
    assert not snapshots.exists(spark, table)
    assert snapshots.overwrite(spark.range(3), table) == 1
    assert snapshots.append(spark.range(2).withColumn("extra", F.lit("x")), table) == 2
    assert snapshots.read(spark, table, version=1).count() == 3
    latest = snapshots.read(spark, table)
    assert latest.count() == 5 and latest.where("extra IS NULL").count() == 3
    with pytest.raises(snapshots.TooFewRows):
        snapshots.overwrite(spark.range(1), table, min_rows=2)
    assert snapshots.read(spark, table).count() == 5
    assert snapshots.overwrite(spark.range(9), table, partition_by=None, min_rows=2) == 3
    moment = snapshots.versions(spark, table)[1][1]
    assert snapshots.read(spark, table, as_of=moment).count() in (5, 9)
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, table, version=8)


def test_watermark_pull_and_widening(spark):
    df = spark.createDataFrame([(1, D1), (2, D2)], "id INT, at TIMESTAMP")
    assert files.changed_rows(df, "at", None).count() == 2
    assert [r["id"] for r in files.changed_rows(df, "at", D1).collect()] == [2]
    assert files.widen(df, df.withColumn("x", F.lit(1))).columns == ["id", "at", "x"]


def test_feed_options():
    options = files.feed_options("host:9093", "orders", "g", {"kafka.security.protocol": "SASL_SSL"})
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["subscribe"] == "orders"


def test_hash_tells_bars_and_nulls_apart(spark):
    from merchlake.functions.scalars import fingerprint

    rows = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("", "a"), ("1:a", ""), ("", "1:a"), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "x STRING, y STRING")
    assert df.select(fingerprint(["x", "y"]).alias("h")).distinct().count() == len(rows)
