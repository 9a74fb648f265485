"""Frames and versions over groups that span many ranges: the same rows as with one window or one join."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from merchlake.functions import ordering
from merchlake.operators import dims, evaluation, features

START = datetime(2024, 1, 1)


def series(spark, n=240):
    rng = random.Random(1)
    data = [(s, START.date() + timedelta(days=d), None if rng.random() < 0.05 else float(rng.randrange(1000)))
            for s, m in (("long", n), ("short", 7), (None, 40)) for d in range(m)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "s string, day date, v double")


@pytest.mark.parametrize("pieces", [1, 5, 40, 400])
def test_rolling_frames_over_ranges(spark, pieces):
    df = series(spark)
    for make in (
        lambda **o: features.with_lags(df, "v", "day", ["s"], **o),
        lambda **o: features.with_rolling(df, "v", "day", ["s"], sizes=(3, 30), **o),
        lambda **o: features.forecast_features(df, "v", "day", ["s"], **o),
        lambda **o: features.revenue_anomalies(df, "last 30 days", START + timedelta(days=235), 5.0, "v", "day", ["s"], **o),
    ):
        plain, spread = make(), make(spread=True, pieces=pieces)
        assert plain.columns == spread.columns and rows(plain) == rows(spread)


def test_one_series_spans_all_ranges_and_only_borders_move(spark):
    df = series(spark).where("s = 'long'")
    cut = ordering.with_halo(df, ["s"], ["day"], 14, pieces=8)
    sizes = {r[ordering.PIECE]: (r["own"], r["halo"]) for r in cut.groupBy(ordering.PIECE).agg(
        F.count(F.when(~F.col(ordering.HALO), 1)).alias("own"), F.count(F.when(F.col(ordering.HALO), 1)).alias("halo")).collect()}
    assert len(sizes) == 8 and max(own for own, _ in sizes.values()) < 60
    assert sorted(halo for _, halo in sizes.values()) == [0] + [14] * 7


@pytest.mark.parametrize("pieces", [1, 6, 50])
def test_versions_are_carried_over_ranges(spark, monkeypatch, pieces):
    """A key with most of the facts and versions, one without versions, one whose versions end; against the plain join."""
    rng = random.Random(pieces)
    versions, facts = [], []
    for key, n in (("hot", 300), ("b", 3), ("ended", 5)):
        for i in range(n):
            until = START + timedelta(hours=i + 1) if i < n - 1 or key == "ended" else datetime(9999, 12, 31)
            versions.append((key, f"{key}{i}", START + timedelta(hours=i), until))
    for i in range(900):
        key = rng.choice(["hot"] * 8 + ["b", "ended", "none", None])
        facts.append((i, key, None if rng.random() < 0.02 else START + timedelta(minutes=rng.randrange(-300, 20_000))))
    dim = spark.createDataFrame(versions, "k string, attr string, valid_from timestamp, valid_to timestamp")
    log = spark.createDataFrame(facts, "id int, k string, at timestamp")
    monkeypatch.setattr(dims, "FEW_VERSIONS", 1000)
    plain = dims.point_in_time_join(log, dim, "k", "at", ["attr"])
    carried = dims.carry_versions(log, dim, "k", "at", ["attr"], pieces)
    assert plain.columns == carried.columns and rows(plain) == rows(carried)
    monkeypatch.setattr(dims, "FEW_VERSIONS", 10)
    chosen = dims.point_in_time_join(log, dim, "k", "at", ["attr"], pieces=pieces)
    assert rows(chosen) == rows(plain)


def test_hot_key_stays_linear(spark):
    """10^5 facts and 10^4 versions of one key: no pair of all of them is made."""
    versions = spark.range(10_000).select(
        F.lit("k").alias("k"), F.col("id").alias("v"), F.timestamp_seconds(F.col("id") * 60).alias("valid_from"),
        F.timestamp_seconds(F.col("id") * 60 + 60).alias("valid_to"))
    facts = spark.range(100_000).select("id", F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 6 + 3).alias("at"))
    joined = dims.point_in_time_join(facts, versions, "k", "at", ["v"])
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where(F.col("v") != F.floor((F.col("id") * 6 + 3) / 60)).count() == 0 and joined.count() == 100_000


def test_cosine_lane(spark):
    data = [(1, "the red car", "the red car"), (2, "the blue car", "the red car"), (3, "the", "zebra"), (4, "", "the"), (5, None, "the"),
            (6, "A a b", "a B b")]
    got = {r["id"]: r["cosine"] for r in evaluation.cosine_scores(
        spark.createDataFrame(data, "id int, a string, e string"), ["id"], "a", "e").collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6} and got[4] is None and got[5] is None
    assert abs(got[1] - 1) < 1e-9 and got[3] == 0 and 0 < got[2] < 0.7 and 0.7 < got[6] < 0.9
