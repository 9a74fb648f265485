import math
import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlake.functions import selection

VALUES = [0.0, -0.0, 1.0, -1.0, 1e-300, -1e300, 1e300, 5e-324, math.inf, -math.inf, 2.0, 2.0000000001, 3.5, -3.5, math.nan]


def test_bins_ascend_with_the_values(spark):
    rng = random.Random(1)
    values = VALUES + [rng.uniform(-1, 1) * 10 ** rng.randrange(-300, 300) for _ in range(3000)]
    got = {r["v"]: r["b"] for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", selection.bin_of("v").alias("b")).collect()}
    ordered = sorted((v for v in got if not math.isnan(v)))
    bins = [got[v] for v in ordered]
    assert bins == sorted(bins) and all(b > bins[-1] for v, b in got.items() if math.isnan(v))


@pytest.mark.parametrize("few", [100_000, 3])
def test_rows_at_ranks(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(few)
    groups = {
        "wide": [rng.uniform(-1e6, 1e6) for _ in range(400)],
        "narrow": [100 + rng.random() / 1000 for _ in range(400)],
        "few": [rng.choice([1.0, 2.0, 2.5]) for _ in range(300)],
        "same": [7.0] * 90,
        None: [rng.gauss(0, 1) for _ in range(50)],
    }
    rows = [(g, v, rng.randrange(1, 4)) for g, vs in groups.items() for v in vs]
    frame = spark.createDataFrame([*rows, ("wide", None, 5)], "g string, v double, n int")
    wanted = [(g, r) for g, vs in groups.items() for r in {0, 1, len(vs) // 3, len(vs) - 1, 10**6}]
    got = selection.at_ranks(frame, ["g"], "v", spark.createDataFrame(wanted, "g string, rank long"), weight="n").collect()
    want = {}
    for g, r in wanted:
        spread = sorted(v for h, v, n in rows if h == g for _ in range(n))
        if r < len(spread):
            want[g, r] = (spread[r], sum(v < spread[r] for v in spread))
    assert {(x["g"], x["rank"]): (x["v"], x["before"]) for x in got} == want and len(got) == len(want)


@pytest.mark.parametrize("few", [100_000, 3])
def test_texts_and_long_numbers_at_ranks(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(few)
    texts = sorted({rng.choice(["", "a", "ab", "abcd", "zé"]) + str(rng.randrange(500)) for _ in range(300)}, key=lambda t: t.encode())
    numbers = sorted({2**60 + rng.randrange(1000) for _ in range(300)})
    ranks = spark.createDataFrame([(1, r) for r in (0, 5, 77, 150)], "s int, rank long")
    for values, kind in ((texts, "string"), (numbers, "long")):
        mixed = rng.sample(values, len(values))
        got = selection.at_ranks(spark.createDataFrame([(1, v) for v in mixed], f"s int, v {kind}"), ["s"], "v", ranks)
        assert {r["rank"]: (r["v"], r["before"]) for r in got.collect()} == {k: (values[k], k) for k in (0, 5, 77, 150)}


@pytest.mark.parametrize("few", [100_000, 3])
def test_percentiles_equal_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    rng = np.random.default_rng(5)
    data = {"a": rng.normal(size=301).round(2), "b": np.repeat([1.0, 2.0], [300, 7]), "c": np.array([4.0]), None: rng.random(20)}
    rows = [(g, float(v), "x") for g, vs in data.items() for v in vs] + [("a", None, None), ("none", None, "y")]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE, t STRING")
    probs = {"p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.count_distinct("t").alias("kinds")]
    got = {r["g"]: r for r in selection.with_percentiles(df, ["g"], "v", probs, aggs).collect()}
    assert set(got) == {"a", "b", "c", None, "none"}
    assert (got["none"]["n"], got["none"]["p50"], got["none"]["kinds"]) == (1, None, 1) and got["a"]["n"] == 302
    for g, values in data.items():
        assert abs(got[g]["total"] - values.sum()) < 1e-9
        for name, p in probs.items():
            assert abs(got[g][name] - np.percentile(values, p * 100)) < 1e-9
    whole = selection.with_percentiles(df, [], "v", probs, aggs).collect()
    everything = np.concatenate(list(data.values()))
    assert len(whole) == 1 and abs(whole[0]["p95"] - np.percentile(everything, 95)) < 1e-9
    nothing = selection.with_percentiles(df.limit(0), [], "v", probs, aggs).collect()
    assert [tuple(r) for r in nothing] == [(0, None, 0, None, None, None, None)]
    assert selection.with_percentiles(df.limit(0), ["g"], "v", probs, aggs).collect() == []


def test_only_rows_of_wanted_bins_are_counted_again(spark, monkeypatch):
    """What is grouped by value after the first pass is a small part of the distinct values."""
    seen, stored = [], selection.stored

    def counted(df, label):
        out = stored(df, label)
        if label == "cells":
            seen.append(out.count())
        return out

    monkeypatch.setattr(selection, "stored", counted)
    monkeypatch.setattr(selection, "FEW", 500)
    df = spark.range(200_000).select((F.col("id") * 0.37 + 5).alias("v"))
    row = selection.with_percentiles(df, [], "v", {"p50": 0.5, "p99": 0.99}).first()
    assert abs(row["p50"] - (199_999 * 0.37 / 2 + 5)) < 1e-6
    assert seen and sum(seen) < 2_000


@pytest.mark.parametrize("few", [100_000, 4])
def test_tiles_equal_ntile(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(9)
    for n, kind in ((0, "string"), (1, "string"), (3, "long"), (5, "string"), (203, "string"), (204, "long")):
        keys = rng.sample(range(1000, 9000), n)
        rows = [(f"c{k}" if kind == "string" else k, rng.choice([1.0, 1.0, 2.0, None]), rng.randrange(3), rng.random()) for k in keys]
        df = spark.createDataFrame(rows, f"key {kind}, a double, b int, c double")
        orderings = {"ta": F.col("a"), "tb": -F.col("b"), "tc": F.col("c")}
        got = {r["key"]: r for r in selection.tiles_of(df, orderings, "key", 5).collect()}
        assert len(got) == n
        for name, of in (("ta", lambda r: -math.inf if r[1] is None else r[1]), ("tb", lambda r: -r[2]), ("tc", lambda r: r[3])):
            ordered = sorted(rows, key=lambda r: (of(r), r[0]))
            base, longer = divmod(n, 5)
            tiles = [t + 1 for t in range(5) for _ in range(base + (t < longer))]
            assert [got[r[0]][name] for r in ordered] == tiles


def test_groups_of_time(spark):
    rows = [(datetime(2024, 1, 1 + i % 2), float(i)) for i in range(100)]
    got = selection.with_percentiles(spark.createDataFrame(rows, "t timestamp, v double"), ["t"], "v", {"m": 0.5}).collect()
    assert sorted(r["m"] for r in got) == [49.0, 50.0]
