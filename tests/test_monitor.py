from datetime import datetime, timedelta

import numpy as np
import pytest

from merchlake.operators import monitor

NOW = datetime(2024, 1, 10, 12)


def model_log(spark):
    data = []
    for i in range(20):
        at = NOW - timedelta(hours=i * 2)
        data.append((at, float(i), "x" if i % 5 == 0 else None, f"v{i % 2}", i, {"amount": "oops" if i == 0 else str(i)}))
    return spark.createDataFrame(
        data, "timestamp TIMESTAMP, latency_ms DOUBLE, error STRING, model_version STRING, request_id INT, "
        "features MAP<STRING,STRING>"
    )


def chat(spark, *data):
    return spark.createDataFrame(list(data), "request_timestamp TIMESTAMP, response STRING, status_code INT")


def test_trend_and_percentiles(spark):
    got = {str(r["date"]): r for r in monitor.latency_trend(model_log(spark), NOW).collect()}
    today = got["2024-01-10"]
    assert today["total_predictions"] == 7
    assert today["p95_latency"] == round(float(np.percentile(range(7), 95)), 2)
    assert (today["error_count"], round(today["error_rate_pct"], 2)) == (2, 28.57)


def test_versions_features_errors(spark):
    log = model_log(spark)
    versions = monitor.version_comparison(log, NOW).collect()
    assert [(r["model_version"], r["total_calls"]) for r in versions] == [("v0", 7), ("v1", 6)]
    hours = monitor.hourly_features(log, NOW, ["amount"], hours=5).collect()
    assert [r["avg_amount"] for r in hours] == [None, 1.0, 2.0]
    errors = monitor.recent_errors(log, NOW, limit=2).collect()
    assert [(r["request_id"], r["age_ms"]) for r in errors] == [(0, 0), (5, 36_000_000)]


def test_health_of_empty_and_busy_log(spark):
    assert monitor.health_summary(model_log(spark), "m", NOW + timedelta(days=9)).first()["status"] == "no_data"
    busy = monitor.health_summary(model_log(spark), "m", NOW).first()
    assert (busy["status"], busy["queries_24h"], busy["model_versions_active"]) == ("degraded", 13, 2)


def test_error_rate_limits(spark):
    fail = (NOW, "r", 500)
    fine = (NOW, "r", 399)
    quiet = monitor.error_rate(chat(spark, (NOW - timedelta(minutes=16), "r", 500)), NOW).first()
    assert (quiet["total"], quiet["alert"], quiet["reason"]) == (0, False, "no requests in window")
    edge = monitor.error_rate(chat(spark, fail, *[fine] * 19), NOW).first()
    assert (edge["error_rate"], edge["alert"]) == (0.05, False)
    over = monitor.error_rate(chat(spark, fail, *[fine] * 18), NOW)
    assert over.first()["alert"]
    with pytest.raises(monitor.AlertRaised):
        monitor.require_quiet(over)
    assert monitor.require_quiet(monitor.error_rate(chat(spark, fine), NOW))["errors"] == 0


@pytest.mark.parametrize("length, alert", [(10, False), (9, True), (40, False), (41, True)])
def test_length_drift_limits_are_exclusive(spark, length, alert):
    log = chat(spark, (NOW - timedelta(days=3), "x" * 20, 200), (NOW, "y" * length, 200),
               (NOW - timedelta(days=8), "z" * 900, 200))
    got = monitor.length_drift(log, NOW).first()
    assert (got["baseline_avg"], got["alert"]) == (20.0, alert)


def test_length_drift_without_baseline(spark):
    got = monitor.length_drift(chat(spark, (NOW, "abc", 200)), NOW).first()
    assert got["alert"] is False and got["drift_ratio"] is None and "no baseline" in got["reason"]


def test_limits_shift_and_slower(spark):
    log = model_log(spark)
    over = {r["metric"]: r["exceeded"] for r in monitor.over_limits(
        monitor.measured_metrics(log, "churn_model", NOW), monitor.limits_table(spark)).collect()}
    assert over == {"p95_latency_ms": False, "p99_latency_ms": False, "error_rate_pct": True}
    shift = monitor.feature_shift(log, ["amount"], NOW).first()
    assert (shift["baseline_avg"], shift["current_avg"], shift["alert"]) == (16.0, 6.5, True)
    versions = spark.createDataFrame(
        [("v8", 1, 100.0), ("v9", 2, 121.0), ("v10", 3, 130.0)], "model_version STRING, first_seen INT, avg_latency_ms DOUBLE")
    assert [r["slower"] for r in monitor.slower_versions(versions).orderBy("avg_latency_ms").collect()] == [False, True, False]
