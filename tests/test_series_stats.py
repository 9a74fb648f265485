from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import rows

from merchlake.operators import features, ml, stats


def daily(spark, values, start=date(2024, 1, 1), skip=()):
    days = [start + timedelta(days=i) for i in range(len(values) + len(skip)) if i not in skip]
    return spark.createDataFrame(list(zip(days, map(float, values))), "order_date DATE, net_revenue DOUBLE")


def test_features_equal_pandas(spark):
    values = np.random.default_rng(0).normal(100, 20, 60).round(2)
    for skip in ((), (17,)):
        got = features.forecast_features(daily(spark, values, skip=skip)).toPandas().sort_values("order_date")
        s = pd.Series(values)
        wanted = pd.DataFrame({f"lag_{k}": s.shift(k) for k in features.LAGS})
        for n in features.ROLLING:
            wanted[f"rolling_mean_{n}"] = s.shift(1).rolling(n).mean()
        wanted = wanted.dropna()
        assert len(got) == len(wanted) == 30
        for c in wanted:
            assert np.allclose(got[c].to_numpy(), wanted[c].to_numpy())
        days = pd.to_datetime(got["order_date"])
        assert list(got["day_of_week"]) == list(days.dt.dayofweek)
        assert list(got["week_of_year"]) == list(days.dt.isocalendar().week)


def test_time_split(spark):
    f = features.forecast_features(daily(spark, range(1, 41)))
    split = features.time_split(f)
    assert [r["order_date"] for r in split.where("is_test").orderBy("order_date").collect()] == [
        date(2024, 2, 8), date(2024, 2, 9)
    ]
    tiny = features.time_split(daily(spark, [1, 2]))
    assert tiny.where("is_test").count() == 1


def test_horizon_falls_back_on_short_history(spark):
    got = features.horizon_features(daily(spark, [10, 20, 30]), date(2024, 1, 3), 200).orderBy("forecast_date").collect()
    assert len(got) == 200 and got[0]["forecast_date"] == date(2024, 1, 4)
    first = got[0]
    assert (first["lag_1"], first["lag_2"], first["lag_3"], first["lag_7"]) == (30.0, 20.0, 10.0, 10.0)
    assert first["rolling_mean_7"] == 20.0
    assert features.horizon_features(daily(spark, []), date(2024, 1, 3)).count() == 0
    with pytest.raises(ValueError):
        features.horizon_features(daily(spark, [1]), date(2024, 1, 3), 0)


def test_anomalies_filter_after_the_window(spark):
    values = [100.0] * 20
    values[15] = 50.0
    table = daily(spark, values).withColumnRenamed("net_revenue", "total_revenue")
    got = features.revenue_anomalies(table, "last 7 days", date(2024, 1, 20)).collect()
    assert [(r["day"], r["rolling_avg_14d_eur"], r["pct_below_avg"]) for r in got] == [("2024-01-16", 96.43, 48.1)]
    assert features.revenue_anomalies(table, "last 7 days", date(2024, 1, 20), 49.0).count() == 0


def auc(pos, neg):
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rng = np.random.default_rng(2)
    pos, neg = rng.integers(0, 10, 80) / 10, rng.integers(0, 8, 120) / 10
    df = spark.createDataFrame([(1, float(x)) for x in pos] + [(0, float(x)) for x in neg], "y INT, s DOUBLE")
    got = stats.classifier_quality(df, "y", "s", pieces=3).first()
    assert got["auc"] == pytest.approx(auc(pos, neg), abs=6e-5)
    called = [(1, s) for s in pos if s > 0.5] + [(0, s) for s in neg if s > 0.5]
    assert got["precision"] == pytest.approx(sum(y for y, _ in called) / len(called), abs=6e-5)
    assert got["recall"] == pytest.approx((pos > 0.5).mean(), abs=6e-5)


def test_one_class_gives_zero(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y INT, s DOUBLE")
    assert tuple(stats.classifier_quality(df, "y", "s").first()) == (0.0, 0.0, 0.0)


def test_regression_figures(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "a DOUBLE, p DOUBLE")
    got = stats.regression_quality(df, "a", "p").first()
    assert (got["mae"], got["rmse"], got["r2"]) == (0.5, 0.65, 0.7321)


def psi(expected, actual):
    """Brute force with numpy's own percentiles and histogram."""
    edges = np.percentile(expected, np.linspace(0, 100, 11))
    both = np.concatenate([expected, actual])
    edges[0], edges[-1] = both.min() - 1, both.max() + 1
    shares = []
    for data in (expected, actual):
        share = np.histogram(data, edges)[0] / len(data)
        shares.append(np.where(share == 0, 0.0001, share))
    return float(((shares[1] - shares[0]) * np.log(shares[1] / shares[0])).sum())


def test_psi_equals_numpy(spark):
    rng = np.random.default_rng(4)
    base = {"same": rng.normal(size=200), "shift": rng.normal(size=200), "flat": np.ones(200),
            "lumpy": rng.integers(0, 4, 200).astype(float)}
    now = {"same": base["same"].copy(), "shift": base["shift"] + 2, "flat": np.ones(200),
           "lumpy": rng.integers(1, 6, 200).astype(float)}
    data = []
    for side, source in ((True, base), (False, now)):
        data += [(side, not side, *[float(source[f][i]) for f in base], None if i > 8 else 1.0) for i in range(200)]
    schema = "is_baseline BOOLEAN, is_current BOOLEAN, same DOUBLE, shift DOUBLE, flat DOUBLE, lumpy DOUBLE, few DOUBLE"
    got = {r["feature"]: r for r in stats.population_stability(
        spark.createDataFrame(data, schema), [*base, "few"]).collect()}
    for f in base:
        assert got[f]["psi"] == pytest.approx(psi(base[f], now[f]), abs=6e-5)
    assert got["same"]["drift"] == "none" and got["shift"]["drift"] == "high"
    assert (got["few"]["psi"], got["few"]["drift"], got["few"]["baseline_rows"]) == (None, "insufficient_data", 9)
    decision = stats.retrain_decision(stats.population_stability(
        spark.createDataFrame(data, schema), ["same", "shift"])).first()
    assert tuple(decision) == (True, "shift")


def test_drift_windows_may_overlap(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1)), (3, datetime(2023, 1, 1)), (4, None)], "id INT, at TIMESTAMP")
    got = stats.drift_windows(df, "at", datetime(2024, 1, 15), datetime(2024, 1, 20))
    assert rows(got.select("id", "is_baseline", "is_current")) == [(1, True, True), (2, False, True), (3, True, False)]


def test_churn_labels_and_weight(spark):
    df = spark.createDataFrame([(91,), (90,), (None,), (10,)], "days_since_last_order INT")
    labelled = ml.churn_labels(df)
    assert sorted(r["is_churned"] for r in labelled.collect()) == [0, 0, 0, 1]
    assert ml.class_weight(labelled).first()["pos_weight"] == 3.0
    assert ml.class_weight(labelled.where("is_churned = 0")).first()["pos_weight"] == 3.0


def test_hash_split_is_stable_and_near_its_share(spark):
    a = ml.hash_split(spark.range(5000), "id")
    b = ml.hash_split(spark.range(5000).repartition(7), "id")
    assert 900 < a.where("is_test").count() < 1100
    assert rows(a.where("is_test").select("id")) == rows(b.where("is_test").select("id"))


def test_models_learn(spark):
    rng = np.random.default_rng(6)
    data = [(float(x), float(rng.normal()), int(x > 0.6)) for x in rng.random(300)]
    df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE, is_churned INT")
    model = ml.train_churn(df, ["a", "b"], trees=3)
    scored = ml.score_churn(model, df, ["a", "b"])
    assert stats.classifier_quality(scored, "is_churned", "churn_probability").first()["auc"] > 0.95
    with pytest.raises(ml.NotEnoughRows):
        ml.train_forecast(features.forecast_features(daily(spark, range(32))), trees=2)


def test_forecast_beats_last_weeks_value(spark):
    values = [100 + 30 * (i % 7) + i % 3 for i in range(150)]
    series = daily(spark, values)
    split = features.time_split(features.forecast_features(series)).persist()
    model = ml.train_forecast(split.where("NOT is_test"), trees=20, rate=0.3)
    scored = ml.score_forecast(model, split.where("is_test"))
    mean = split.where("is_test").withColumnRenamed("rolling_mean_7", "p")
    assert (stats.regression_quality(scored, "net_revenue", "predicted_revenue").first()["mae"]
            < stats.regression_quality(mean, "net_revenue", "p").first()["mae"])
    ahead = ml.forecast(model, series, date(2024, 6, 1), 5)
    assert ahead.count() == 5 and ml.forecast_total(ahead).first()["horizon_days"] == 5


def test_training_rows_lie_in_as_many_partitions_as_there_are_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(5 * cores)
    assert ml.for_training(many).rdd.getNumPartitions() == cores
    assert ml.for_training(many, per_task=1000 // (2 * cores)).rdd.getNumPartitions() >= 2 * cores
    assert rows(ml.for_training(many)) == rows(many)


def test_churn_trees_grow_on_few_partitions(spark, monkeypatch):
    """The model of rows in many partitions is that of the same rows in few, and no job of it has more tasks than cores."""
    cores = spark.sparkContext.defaultParallelism
    data = spark.range(400).selectExpr("CAST(id % 2 AS INT) AS is_churned", "CAST(id % 2 + id % 7 AS DOUBLE) AS a").repartition(10 * cores)
    seen = []
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, frame: seen.append(frame.rdd.getNumPartitions()))
    ml.train_churn(data, ["a"], trees=2)
    assert seen == [cores]
