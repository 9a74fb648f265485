"""Monitoring of model and chat inference logs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.functions.scalars import as_day, money, ratio, since
from merchlake.functions.selection import with_percentiles

# Alert limits.
ERROR_RATE_LIMIT = 0.05
LENGTH_RATIO_LOW = 0.5
LENGTH_RATIO_HIGH = 2.0


class AlertRaised(RuntimeError):
    """A monitoring check fired; the job is meant to fail."""


def _error_columns(count_name: str) -> list[Column]:
    errors = F.count("error")
    return [errors.alias(count_name), (errors * F.lit(100.0) / F.count(F.lit(1))).alias("error_rate_pct")]


def _with_percentiles(rows: DataFrame, group: list[str], value: str, probs: dict[str, float], aggs: list[Column],
                      approximate: bool = False) -> DataFrame:
    """Aggregates and percentiles per group.

    Exact percentiles come from counts of bins that are made in the same pass as
    the aggregates; `approximate` uses a sketch instead.
    """
    if approximate:
        sketches = [F.percentile_approx(value, p, 100_000).cast("double").alias(n) for n, p in probs.items()]
        return rows.groupBy(*group).agg(*aggs, *sketches)
    return with_percentiles(rows, group, value, probs, aggs)


def latency_trend(log: DataFrame, as_of: datetime, days: int = 7, approximate: bool = False) -> DataFrame:
    """Calls, latency and errors per day since `days` before today."""
    start = as_day(as_of) - timedelta(days=days)
    rows = log.where(F.col("timestamp") >= F.lit(start)).withColumn("date", F.to_date("timestamp"))
    aggs = [
        F.count(F.lit(1)).alias("total_predictions"),
        money(F.avg("latency_ms")).alias("avg_latency"),
        *_error_columns("error_count"),
    ]
    found = _with_percentiles(
        rows, ["date"], "latency_ms", {"p95_latency": 0.95, "p99_latency": 0.99}, aggs, approximate
    )
    return found.withColumns({c: money(c) for c in ("p95_latency", "p99_latency")}).orderBy(F.desc("date"))


def version_comparison(log: DataFrame, as_of: datetime, hours: int = 24, approximate: bool = False) -> DataFrame:
    rows = log.where(since("timestamp", as_of, hours=hours))
    aggs = [
        F.count(F.lit(1)).alias("total_calls"),
        F.min("timestamp").alias("first_seen"),
        money(F.avg("latency_ms")).alias("avg_latency_ms"),
        *_error_columns("errors"),
    ]
    found = _with_percentiles(rows, ["model_version"], "latency_ms", {"p95_latency_ms": 0.95}, aggs, approximate)
    return found.withColumn("p95_latency_ms", money("p95_latency_ms")).orderBy(F.desc("total_calls"), "model_version")


def hourly_features(log: DataFrame, as_of: datetime, names: list[str], hours: int = 24) -> DataFrame:
    """Hourly mean of entries of the features map; text that is no number is skipped."""
    rows = log.where(since("timestamp", as_of, hours=hours))
    means = [money(F.avg(F.try_element_at("features", F.lit(n)).try_cast("double"))).alias(f"avg_{n}") for n in names]
    return (
        rows.groupBy(F.date_trunc("hour", "timestamp").alias("hour"))
        .agg(F.count(F.lit(1)).alias("predictions"), *means)
        .orderBy(F.desc("hour"))
    )


def recent_errors(log: DataFrame, as_of: datetime, hours: int = 24, limit: int = 100) -> DataFrame:
    rows = log.where(F.col("error").isNotNull() & since("timestamp", as_of, hours=hours))
    age = F.timestamp_diff("MILLISECOND", F.col("timestamp"), F.lit(as_of).cast("timestamp"))
    return (
        rows.select("timestamp", "model_version", "error", "request_id", age.alias("age_ms"))
        .orderBy(F.desc("timestamp"), F.desc("request_id"))
        .limit(limit)
    )


def health_summary(log: DataFrame, model: str, as_of: datetime, error_limit_pct: float = 1.0,
                   p95_limit_ms: float = 500.0, p99_limit_ms: float = 1000.0) -> DataFrame:
    """One row on the last 24 hours: volume, errors, latency, active versions and a status."""
    rows = log.where(since("timestamp", as_of, hours=24))
    aggs = [
        F.count("error").alias("error_count_24h"),
        money(F.avg("latency_ms")).alias("avg_latency_ms"),
        F.count_distinct("model_version").alias("model_versions_active"),
        F.count(F.lit(1)).alias("queries_24h"),
    ]
    found = _with_percentiles(
        rows, [], "latency_ms", {"p95_latency_ms": 0.95, "p99_latency_ms": 0.99}, aggs
    )
    error_pct = ratio(F.col("error_count_24h") * 100.0, F.col("queries_24h"))
    bad = (error_pct > error_limit_pct) | (F.col("p95_latency_ms") > p95_limit_ms) | (
        F.col("p99_latency_ms") > p99_limit_ms
    )
    return found.select(
        F.lit(model).alias("model_name"),
        F.when(F.col("queries_24h") == 0, "no_data").when(bad, "degraded").otherwise("healthy").alias("status"),
        "error_count_24h",
        "avg_latency_ms",
        money("p95_latency_ms").alias("p95_latency_ms"),
        money("p99_latency_ms").alias("p99_latency_ms"),
        "model_versions_active",
        "queries_24h",
    )


def error_rate(log: DataFrame, as_of: datetime, minutes: int = 15, limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Share of failed requests (status 400 and up) of the last minutes; no request raises no alert."""
    rows = log.where(since("request_timestamp", as_of, minutes=minutes))
    sums = rows.agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("status_code") >= 400, 1)).alias("errors")
    )
    share = F.coalesce(F.col("errors") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    reason = F.when(F.col("total") == 0, "no requests in window").when(
        share > limit,
        F.format_string(
            f"error rate %.1f%% in last {minutes} min (%d/%d requests)",
            share * 100,
            F.col("errors"),
            F.col("total"),
        ),
    )
    return sums.select(
        "total",
        "errors",
        F.round(share, 4).alias("error_rate"),
        (share > limit).alias("alert"),
        F.coalesce(reason, F.lit("")).alias("reason"),
    )


def length_drift(
    log: DataFrame,
    as_of: datetime,
    hours: int = 24,
    days: int = 7,
    low: float = LENGTH_RATIO_LOW,
    high: float = LENGTH_RATIO_HIGH,
) -> DataFrame:
    """Mean response length of the last hours against the days up to that window, in one pass."""
    split = F.lit(as_of - timedelta(hours=hours))
    length = F.length("response")
    moment = F.col("request_timestamp")
    oldest = min(as_of - timedelta(days=days), as_of - timedelta(hours=hours))
    baseline = (moment < split) & (moment >= F.lit(as_of - timedelta(days=days)))
    means = log.where(moment >= F.lit(oldest)).agg(
        F.avg(F.when(baseline, length)).alias("_base"), F.avg(F.when(moment >= split, length)).alias("_now")
    )
    change = F.col("_now") / F.nullif(F.col("_base"), F.lit(0.0))
    alert = F.coalesce((change < low) | (change > high), F.lit(False))
    reason = F.when(change.isNull(), "insufficient data — no baseline yet").when(
        alert, F.format_string(f"response length changed by %+.0f%% vs. {days}-day baseline", (change - 1) * 100)
    )
    known = change.isNotNull()
    return means.select(
        F.when(known, money("_base", 1)).alias("baseline_avg"),
        F.when(known, money("_now", 1)).alias("current_avg"),
        money(change, 3).alias("drift_ratio"),
        alert.alias("alert"),
        F.coalesce(reason, F.lit("")).alias("reason"),
    )


@dataclass(frozen=True)
class Limits:
    """Alert limits of one model (defaults are fixed values)."""

    model: str
    p95_ms: float = 500.0
    p99_ms: float = 1000.0
    error_pct: float = 1.0
    drift_pct: float = 10.0
    enabled: bool = True


# Limits of the two served models.
MODEL_LIMITS = (
    Limits("forecast_model", p95_ms=500.0, error_pct=1.0, drift_pct=10.0),
    Limits("churn_model", p95_ms=400.0, error_pct=0.5, drift_pct=8.0),
)


def limits_table(spark, limits=MODEL_LIMITS) -> DataFrame:
    rows = [(x.model, m, v) for x in limits if x.enabled for m, v in (
        ("p95_latency_ms", x.p95_ms),
        ("p99_latency_ms", x.p99_ms),
        ("error_rate_pct", x.error_pct),
        ("drift_pct", x.drift_pct),
    )]
    return spark.createDataFrame(rows, "model_name STRING, metric STRING, threshold DOUBLE")


def over_limits(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Measured (model_name, metric, value) rows against the limits; exceeding is strict.

    Both sides hold a few rows per model.
    """
    return limits.join(measured, ["model_name", "metric"]).select(
        "model_name",
        "metric",
        "value",
        "threshold",
        F.coalesce(F.col("value") > F.col("threshold"), F.lit(False)).alias("exceeded"),
    )


def measured_metrics(log: DataFrame, model: str, as_of: datetime, hours: int = 24):
    """p95, p99 and error rate of a model's log as (model_name, metric, value) rows."""
    rows = log.where(since("timestamp", as_of, hours=hours))
    aggs = [(F.count("error") * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("error_rate_pct")]
    found = _with_percentiles(
        rows, [], "latency_ms", {"p95_latency_ms": 0.95, "p99_latency_ms": 0.99}, aggs
    )
    names = ["p95_latency_ms", "p99_latency_ms", "error_rate_pct"]
    return found.select(
        F.lit(model).alias("model_name"),
        F.stack(F.lit(len(names)), *[x for n in names for x in (F.lit(n), money(n))]).alias("metric", "value"),
    )


def feature_shift(log: DataFrame, features: list[str], as_of: datetime, hours: int = 24, days: int = 7,
                  limit_pct: float = 10.0) -> DataFrame:
    """Mean of each map feature in the last hours against the days before, in one pass."""
    split = F.lit(as_of - timedelta(hours=hours))
    moment = F.col("timestamp")
    rows = log.where(moment >= F.lit(as_of - timedelta(days=days)))
    columns = []
    for name in features:
        value = F.try_element_at("features", F.lit(name)).try_cast("double")
        columns += [
            F.avg(F.when(moment < split, value)).alias(f"b_{name}"),
            F.avg(F.when(moment >= split, value)).alias(f"c_{name}"),
        ]
    cells = [x for n in features for x in (F.lit(n), F.col(f"b_{n}"), F.col(f"c_{n}"))]
    long = rows.agg(*columns).select(F.stack(F.lit(len(features)), *cells).alias("feature", "_base", "_now"))
    change = ratio((F.col("_now") - F.col("_base")) * 100, F.col("_base"))
    return long.select(
        "feature",
        money("_base").alias("baseline_avg"),
        money("_now").alias("current_avg"),
        money(change, 1).alias("shift_pct"),
        F.coalesce(F.abs(change) > limit_pct, F.lit(False)).alias("alert"),
    )


def slower_versions(comparison: DataFrame, limit_pct: float = 20.0) -> DataFrame:
    """Each version's mean latency against the version before it (one row per version), in the order of `first_seen`."""
    previous = F.lag("avg_latency_ms").over(Window.orderBy("first_seen", "model_version"))
    change = ratio((F.col("avg_latency_ms") - F.col("_previous")) * 100, F.col("_previous"))
    return comparison.withColumn("_previous", previous).select(
        "model_version",
        "avg_latency_ms",
        F.col("_previous").alias("previous_avg_ms"),
        money(change, 1).alias("change_pct"),
        F.coalesce(change > limit_pct, F.lit(False)).alias("slower"),
    )


def windowed_error_rate(log: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Error rate per tumbling window; works on batch and streaming frames alike."""
    return (
        log.groupBy(F.window("request_timestamp", width))
        .agg(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("status_code") >= 400, 1)).alias("errors"))
        .select(
            F.col("window.start").alias("window_start"),
            "total",
            "errors",
            F.round(F.col("errors") / F.col("total"), 4).alias("error_rate"),
        )
    )


def require_quiet(check: DataFrame) -> dict:
    """Run a one-row check and fail the job if it alerts."""
    row = check.first().asDict()
    if row["alert"]:
        raise AlertRaised(row.get("reason") or "alert")
    return row
