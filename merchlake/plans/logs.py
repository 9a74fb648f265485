"""Monitoring of the model and chat logs derived from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from merchlake.functions.scalars import money
from merchlake.functions.selection import with_percentiles
from merchlake.operators import monitor
from merchlake.plans.registry import CTES, day, moment, query, rounded
from merchlake.sources import testdata

CTES["log_clock"] = "SELECT max(ts) AS now FROM events"


def _log(spark, sf):
    log = testdata.model_log(spark, sf)
    return log, testdata.latest(log, "timestamp")


def _chat(spark, sf):
    log = testdata.chat_log(spark, sf)
    return log, testdata.latest(log, "request_timestamp")


def _back(interval: str) -> str:
    return f"(SELECT now FROM log_clock) - INTERVAL {interval}"


_ERROR_RATE = "count(error) * 100.0 / count(*) AS error_rate_pct"


@query(
    "latency_trend",
    f"""SELECT {day('"timestamp"')} AS date, count(*) AS total_predictions, {rounded("avg(latency_ms)")} AS avg_latency,
               {rounded("quantile_cont(latency_ms, 0.95)")} AS p95_latency,
               {rounded("quantile_cont(latency_ms, 0.99)")} AS p99_latency, count(error) AS error_count, {_ERROR_RATE}
        FROM model_log WHERE "timestamp" >= CAST((SELECT now FROM log_clock) AS DATE) - INTERVAL 7 DAY GROUP BY 1""",
)
def latency_trend(spark, sf):
    return monitor.latency_trend(*_log(spark, sf))


@query(
    "latency_trend_sketched",
    f"""SELECT {day('"timestamp"')} AS date, count(*) AS total_predictions, {rounded("avg(latency_ms)")} AS avg_latency,
               {rounded("quantile_disc(latency_ms, 0.95)")} AS p95_latency,
               {rounded("quantile_disc(latency_ms, 0.99)")} AS p99_latency, count(error) AS error_count, {_ERROR_RATE}
        FROM model_log WHERE "timestamp" >= CAST((SELECT now FROM log_clock) AS DATE) - INTERVAL 7 DAY GROUP BY 1""",
)
def latency_trend_sketched(spark, sf):
    return monitor.latency_trend(*_log(spark, sf), approximate=True)


@query(
    "version_comparison",
    f"""SELECT model_version, count(*) AS total_calls, {moment('min("timestamp")')} AS first_seen,
               {rounded("avg(latency_ms)")} AS avg_latency_ms,
               {rounded("quantile_cont(latency_ms, 0.95)")} AS p95_latency_ms, count(error) AS errors, {_ERROR_RATE}
        FROM model_log WHERE "timestamp" >= {_back("24 HOUR")} GROUP BY 1""",
)
def version_comparison(spark, sf):
    return monitor.version_comparison(*_log(spark, sf))


@query(
    "hourly_feature_means",
    f"""SELECT {moment('date_trunc(\'hour\', "timestamp")')} AS hour, count(*) AS predictions,
               {rounded("avg(feature_k)")} AS avg_k, CAST(NULL AS DOUBLE) AS avg_missing
        FROM model_log WHERE "timestamp" >= {_back("24 HOUR")} GROUP BY 1""",
)
def hourly_feature_means(spark, sf):
    log, now = _log(spark, sf)
    return monitor.hourly_features(log, now, ["k", "missing"])


@query(
    "recent_errors",
    f"""SELECT {moment('"timestamp"')} AS "timestamp", model_version, error, request_id,
               CAST(floor(epoch_us((SELECT now FROM log_clock) - "timestamp") / 1000) AS BIGINT) AS age_ms
        FROM model_log m WHERE error IS NOT NULL AND "timestamp" >= {_back("24 HOUR")}
        ORDER BY m."timestamp" DESC, request_id DESC LIMIT 100""",
)
def recent_errors(spark, sf):
    return monitor.recent_errors(*_log(spark, sf))


@query(
    "model_health",
    f"""SELECT 'churn_model' AS model_name,
               CASE WHEN e * 100.0 / n > 1 OR p95 > 500 OR p99 > 1000 THEN 'degraded' ELSE 'healthy' END AS status,
               e AS error_count_24h, mean AS avg_latency_ms, {rounded("p95")} AS p95_latency_ms,
               {rounded("p99")} AS p99_latency_ms, v AS model_versions_active, n AS queries_24h
        FROM (SELECT count(error) AS e, {rounded("avg(latency_ms)")} AS mean, count(*) AS n,
                     quantile_cont(latency_ms, 0.95) AS p95, quantile_cont(latency_ms, 0.99) AS p99,
                     count(DISTINCT model_version) AS v
              FROM model_log WHERE "timestamp" >= {_back("24 HOUR")})""",
)
def model_health(spark, sf):
    log, now = _log(spark, sf)
    return monitor.health_summary(log, "churn_model", now)


@query(
    "chat_error_rate",
    f"""SELECT n AS total, e AS errors, round(e / n, 4) AS error_rate, e / n > 0.05 AS alert
        FROM (SELECT count(*) AS n, count(CASE WHEN status_code >= 400 THEN 1 END) AS e FROM chat_log
              WHERE request_timestamp >= {_back("24 HOUR")})""",
)
def chat_error_rate(spark, sf):
    log, now = _chat(spark, sf)
    return monitor.error_rate(log, now, minutes=24 * 60).drop("reason")


@query(
    "chat_length_drift",
    f"""SELECT {rounded("b", 1)} AS baseline_avg, {rounded("c", 1)} AS current_avg, {rounded("c / b", 3)} AS drift_ratio,
               c / b < 0.5 OR c / b > 2.0 AS alert
        FROM (SELECT avg(CASE WHEN request_timestamp < {_back("24 HOUR")}
                               AND request_timestamp >= {_back("7 DAY")} THEN length(response) END) AS b,
                     avg(CASE WHEN request_timestamp >= {_back("24 HOUR")} THEN length(response) END) AS c
              FROM chat_log)""",
)
def chat_length_drift(spark, sf):
    return monitor.length_drift(*_chat(spark, sf)).drop("reason")


CTES["log_day"] = f"""SELECT * FROM model_log WHERE "timestamp" >= {_back("24 HOUR")}"""


@query(
    "model_limits",
    f"""SELECT 'churn_model' AS model_name, metric, value, threshold, COALESCE(value > threshold, FALSE) AS exceeded
        FROM (SELECT 'p95_latency_ms' AS metric, {rounded("quantile_cont(latency_ms, 0.95)")} AS value, 400.0 AS threshold
              FROM log_day
              UNION ALL SELECT 'p99_latency_ms', {rounded("quantile_cont(latency_ms, 0.99)")}, 1000.0 FROM log_day
              UNION ALL SELECT 'error_rate_pct', {rounded("count(error) * 100.0 / count(*)")}, 0.5 FROM log_day)""",
)
def model_limits(spark, sf):
    log, now = _log(spark, sf)
    return monitor.over_limits(monitor.measured_metrics(log, "churn_model", now), monitor.limits_table(spark))


@query(
    "feature_mean_shift",
    f"""SELECT 'k' AS feature, {rounded("b")} AS baseline_avg, {rounded("c")} AS current_avg,
               {rounded("(c - b) * 100 / b", 1)} AS shift_pct, abs((c - b) * 100 / b) > 10 AS alert
        FROM (SELECT avg(CASE WHEN "timestamp" < {_back("24 HOUR")} AND "timestamp" >= {_back("7 DAY")}
                              THEN feature_k END) AS b,
                     avg(CASE WHEN "timestamp" >= {_back("24 HOUR")} THEN feature_k END) AS c FROM model_log)""",
)
def feature_mean_shift(spark, sf):
    log, now = _log(spark, sf)
    return monitor.feature_shift(log, ["k"], now)


@query(
    "slower_versions",
    f"""SELECT model_version, mean AS avg_latency_ms, prev AS previous_avg_ms,
               {rounded("(mean - prev) * 100 / prev", 1)} AS change_pct,
               COALESCE((mean - prev) * 100 / prev > 20, FALSE) AS slower
        FROM (SELECT *, lag(mean) OVER (ORDER BY seen, model_version) AS prev FROM (
              SELECT model_version, min("timestamp") AS seen, {rounded("avg(latency_ms)")} AS mean FROM log_day GROUP BY 1))""",
)
def slower_versions(spark, sf):
    log, now = _log(spark, sf)
    return monitor.slower_versions(monitor.version_comparison(log, now))


@query(
    "error_rate_per_quarter_hour",
    f"""SELECT {moment("time_bucket(INTERVAL 15 MINUTE, request_timestamp)")} AS window_start, count(*) AS total,
               count(CASE WHEN status_code >= 400 THEN 1 END) AS errors,
               round(count(CASE WHEN status_code >= 400 THEN 1 END) / count(*), 4) AS error_rate
        FROM chat_log GROUP BY 1""",
)
def error_rate_per_quarter_hour(spark, sf):
    return monitor.windowed_error_rate(testdata.chat_log(spark, sf))


@query(
    "price_percentiles_per_line_status",
    f"""SELECT l_returnflag, {rounded("quantile_cont(l_extendedprice, 0.5)")} AS median,
               {rounded("quantile_cont(l_extendedprice, 0.95)")} AS p95,
               {rounded("quantile_cont(l_extendedprice, 0.99)")} AS p99 FROM lineitem GROUP BY 1""",
)
def price_percentiles_per_line_status(spark, sf):
    found = with_percentiles(
        testdata.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice",
        {"median": 0.5, "p95": 0.95, "p99": 0.99},
    )
    return found.select("l_returnflag", *[money(c).alias(c) for c in ("median", "p95", "p99")])


@query(
    "request_counts_by_status",
    """SELECT CAST(status_code AS BIGINT) AS status_code, count(*) AS n, count(DISTINCT request) AS kinds
       FROM chat_log GROUP BY 1""",
)
def request_counts_by_status(spark, sf):
    return testdata.chat_log(spark, sf).groupBy("status_code").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("request").alias("kinds")
    )
