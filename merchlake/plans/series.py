"""Daily series: anomalies, features, model figures, training and drift."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlake.functions.scalars import money
from merchlake.operators import features, ml, quality, stats
from merchlake.plans.commerce import _START, SUMMARY_SQL, Lake, _today, summary
from merchlake.plans.registry import CTES, day, query, rounded
from merchlake.sources import testdata

CTES["day_series"] = "SELECT order_date, net_revenue FROM revenue_days"


def _series(spark, sf):
    return Lake(spark, sf).revenue.select("order_date", "net_revenue")


@query(
    "revenue_anomalies_30_days",
    f"""SELECT {day("order_date")} AS day, {rounded("total_revenue")} AS revenue_eur,
               {rounded("mean")} AS rolling_avg_14d_eur,
               {rounded("100.0 * (mean - total_revenue) / nullif(mean, 0)", 1)} AS pct_below_avg
        FROM (SELECT *, avg(total_revenue) OVER (ORDER BY order_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS mean
              FROM revenue_served)
        WHERE order_date >= {_START["last 30 days"]} AND total_revenue < mean * 0.7""",
)
def revenue_anomalies_30_days(spark, sf):
    lake = Lake(spark, sf)
    return features.revenue_anomalies(lake.serving["revenue_daily"], "last 30 days", lake.as_of)


@query(
    "revenue_anomalies_per_category",
    f"""SELECT category, {day("order_date")} AS day, {rounded("total_revenue")} AS revenue_eur,
               {rounded("mean")} AS rolling_avg_14d_eur,
               {rounded("100.0 * (mean - total_revenue) / nullif(mean, 0)", 1)} AS pct_below_avg
        FROM (SELECT *, avg(total_revenue) OVER (PARTITION BY category ORDER BY order_date
                        ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS mean
              FROM (SELECT category, CAST(order_ts AS DATE) AS order_date, {rounded("sum(line_total)")} AS total_revenue
                    FROM good_orders JOIN products USING (product_id) GROUP BY 1, 2))
        WHERE order_date >= {_START["last month"]} AND total_revenue < mean * 0.5""",
)
def revenue_anomalies_per_category(spark, sf):
    lake = Lake(spark, sf)
    daily = (
        lake.orders.join(lake.products.select("product_id", "category"), "product_id")
        .groupBy("category", F.to_date("order_ts").alias("order_date"))
        .agg(money(F.sum("line_total")).alias("total_revenue"))
    )
    return features.revenue_anomalies(daily, "last month", lake.as_of, 50.0, series=["category"])


_LAG_SQL = ", ".join(f"lag(net_revenue, {k}) OVER (ORDER BY order_date) AS lag_{k}" for k in features.LAGS)
_ROLL_SQL = ", ".join(
    f"CASE WHEN count(*) OVER (ORDER BY order_date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) = {n} "
    f"THEN avg(net_revenue) OVER (ORDER BY order_date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END "
    f"AS rolling_mean_{n}"
    for n in features.ROLLING
)
CTES["feature_rows"] = f"""
    SELECT * FROM (
        SELECT order_date, net_revenue, CAST(isodow(order_date) - 1 AS BIGINT) AS day_of_week,
               CAST(day(order_date) AS BIGINT) AS day_of_month, CAST(month(order_date) AS BIGINT) AS month,
               CAST(weekofyear(order_date) AS BIGINT) AS week_of_year, {_LAG_SQL}, {_ROLL_SQL}
        FROM day_series)
    WHERE rolling_mean_30 IS NOT NULL AND lag_14 IS NOT NULL"""
_ROLL_ROUNDED = ", ".join(f"{rounded(f'rolling_mean_{n}')} AS rolling_mean_{n}" for n in features.ROLLING)
_PLAIN_COLUMNS = ", ".join(["day_of_week", "day_of_month", "month", "week_of_year"] + [f"lag_{k}" for k in features.LAGS])


def _rounded_rolls(df):
    return df.withColumns({f"rolling_mean_{n}": money(f"rolling_mean_{n}") for n in features.ROLLING})


@query(
    "forecast_features",
    f"SELECT {day('order_date')} AS order_date, net_revenue, {_PLAIN_COLUMNS}, {_ROLL_ROUNDED} FROM feature_rows",
)
def forecast_features(spark, sf):
    return _rounded_rolls(features.forecast_features(_series(spark, sf)))


@query(
    "forecast_time_split",
    """SELECT is_test, count(*) AS n, min(strftime(order_date, '%Y-%m-%d')) AS first_day FROM (
           SELECT order_date, row_number() OVER (ORDER BY order_date DESC)
                  <= greatest(1, CAST(floor(count(*) OVER () * 0.2) AS BIGINT)) AS is_test FROM feature_rows)
       GROUP BY 1""",
)
def forecast_time_split(spark, sf):
    split = features.time_split(features.forecast_features(_series(spark, sf)))
    return split.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), F.min("order_date").alias("first_day"))


@query(
    "last_30_days_of_series",
    f"SELECT {day('order_date')} AS order_date, net_revenue FROM day_series ORDER BY day_series.order_date DESC LIMIT 30",
)
def last_30_days_of_series(spark, sf):
    return features.tail(_series(spark, sf), 30)


_HISTORY_LAGS = ", ".join(f"h[len(h) - {k} + 1] AS lag_{k}" for k in features.LAGS)
_HISTORY_MEANS = ", ".join(
    f"{rounded(f'list_avg(h[len(h) - {n} + 1 : len(h)])')} AS rolling_mean_{n}" for n in features.ROLLING
)


@query(
    "horizon_features",
    f"""SELECT strftime(d, '%Y-%m-%d') AS forecast_date, CAST(isodow(d) - 1 AS BIGINT) AS day_of_week,
               CAST(day(d) AS BIGINT) AS day_of_month, CAST(month(d) AS BIGINT) AS month,
               CAST(weekofyear(d) AS BIGINT) AS week_of_year, {_HISTORY_LAGS}, {_HISTORY_MEANS}
        FROM (SELECT list(net_revenue ORDER BY order_date) AS h
              FROM (SELECT * FROM day_series ORDER BY order_date DESC LIMIT 30)),
             (SELECT CAST({_today()} + to_days(CAST(i AS INTEGER)) AS DATE) AS d FROM range(1, 15) r(i))""",
)
def horizon_features(spark, sf):
    lake = Lake(spark, sf)
    return _rounded_rolls(features.horizon_features(_series(spark, sf), lake.as_of.date(), 14))


@query(
    "forecast_error_of_last_week_value",
    f"""SELECT {rounded("avg(abs(net_revenue - lag_7))")} AS mae,
               {rounded("sqrt(avg((net_revenue - lag_7) * (net_revenue - lag_7)))")} AS rmse,
               round(1 - avg((net_revenue - lag_7) * (net_revenue - lag_7)) / var_pop(net_revenue), 4) AS r2
        FROM feature_rows""",
)
def forecast_error_of_last_week_value(spark, sf):
    rows = features.forecast_features(_series(spark, sf))
    return stats.regression_quality(rows, "net_revenue", "lag_7")


@query(
    "forecast_total_of_weekly_mean",
    f"""SELECT 14 AS horizon_days, {rounded(f"14 * {rounded('list_avg(h[len(h) - 6 : len(h)])')}")} AS total_revenue
        FROM (SELECT list(net_revenue ORDER BY order_date) AS h FROM day_series)""",
)
def forecast_total_of_weekly_mean(spark, sf):
    """The total of a horizon forecast; the mean of the last week stands in for the model, so that SQL can follow."""
    rows = features.horizon_features(_series(spark, sf), Lake(spark, sf).as_of.date(), 14)
    return ml.forecast_total(rows.select("forecast_date", money("rolling_mean_7").alias("predicted_revenue")))


@query("forecast_total_next_days")
def forecast_total_next_days(spark, sf):
    """The total of the trained model's forecast; trees have no SQL form."""
    return ml.forecast_total(forecast_next_days(spark, sf))


_ROLLED = ", ".join(
    f"""CASE WHEN count(o_totalprice) OVER w{n} = {n} THEN avg(o_totalprice) OVER w{n} END AS mean_{n}""" for n in (7, 30)
)


@query(
    "order_price_path",
    f"""SELECT o_orderkey, lag_1, lag_14, {rounded("mean_7")} AS rolling_mean_7, {rounded("mean_30")} AS rolling_mean_30
        FROM (SELECT o_orderkey, lag(o_totalprice, 1) OVER w AS lag_1, lag(o_totalprice, 14) OVER w AS lag_14, {_ROLLED} FROM orders
              WINDOW w AS (ORDER BY o_orderkey), w7 AS (ORDER BY o_orderkey ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
                     w30 AS (ORDER BY o_orderkey ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))""",
)
def order_price_path(spark, sf):
    """All orders as one series, longer than a task should hold: ranges with the rows just before them."""
    prices = testdata.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    lagged = features.with_lags(prices, "o_totalprice", "o_orderkey", lags=(1, 14), spread=True)
    rolled = features.with_rolling(lagged, "o_totalprice", "o_orderkey", sizes=(7, 30), spread=True)
    return rolled.select("o_orderkey", "lag_1", "lag_14", money("rolling_mean_7").alias("rolling_mean_7"),
                         money("rolling_mean_30").alias("rolling_mean_30"))


@query(
    "business_summary_with_forecast",
    f"""{SUMMARY_SQL}
        UNION ALL SELECT 'forecast', strftime(d, '%Y-%m-%d'), {rounded("list_avg(h[len(h) - 6 : len(h)])")}
        FROM (SELECT list(net_revenue ORDER BY order_date) AS h FROM day_series),
             (SELECT CAST({_today()} + to_days(CAST(i AS INTEGER)) AS DATE) AS d FROM range(1, 8) r(i))""",
)
def business_summary_with_forecast(spark, sf):
    """All sections of the summary; the mean of the last week stands in for the model, so that SQL can follow."""
    lake = Lake(spark, sf)
    rows = features.horizon_features(_series(spark, sf), lake.as_of.date(), 7)
    return summary(lake, rows.select("forecast_date", money("rolling_mean_7").alias("predicted_revenue")))


# --- churn ------------------------------------------------------------------

CTES["churn_rows"] = """
    SELECT *, CASE WHEN days_since_last_order > 30 THEN 1 ELSE 0 END AS is_churned,
           round(1.0 / (1 + total_orders), 6) AS score
    FROM customer_facts WHERE days_since_last_order IS NOT NULL"""


def _labelled(lake: Lake):
    return ml.churn_labels(lake.customer_metrics, 30).where(F.col("days_since_last_order").isNotNull())


@query(
    "churn_labels",
    """SELECT CASE WHEN days_since_last_order > 90 THEN 1 ELSE 0 END AS is_churned, count(*) AS n
       FROM customer_facts GROUP BY 1""",
)
def churn_labels(spark, sf):
    rows = ml.churn_labels(Lake(spark, sf).customer_metrics)
    return rows.groupBy("is_churned").agg(F.count(F.lit(1)).alias("n"))


@query(
    "churn_class_weight",
    """SELECT round(sum(CASE WHEN is_churned = 0 THEN 1 ELSE 0 END) * 1.0
              / greatest(sum(CASE WHEN is_churned = 1 THEN 1 ELSE 0 END), 1), 6) AS pos_weight FROM churn_rows""",
)
def churn_class_weight(spark, sf):
    return ml.class_weight(_labelled(Lake(spark, sf))).select(F.round("pos_weight", 6).alias("pos_weight"))


@query(
    "churn_score_quality",
    """SELECT round((sum(CASE WHEN is_churned = 1 THEN place END) - sum(is_churned) * (sum(is_churned) + 1) / 2.0)
                    / (sum(is_churned) * (count(*) - sum(is_churned))), 4) AS auc,
              round(COALESCE(sum(CASE WHEN score > 0.03 AND is_churned = 1 THEN 1.0 END)
                    / nullif(count(CASE WHEN score > 0.03 THEN 1 END), 0), 0), 4) AS precision,
              round(COALESCE(sum(CASE WHEN score > 0.03 AND is_churned = 1 THEN 1.0 END)
                    / nullif(sum(is_churned), 0), 0), 4) AS recall
       FROM (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM churn_rows)""",
)
def churn_score_quality(spark, sf):
    rows = _labelled(Lake(spark, sf)).withColumn("score", F.round(1.0 / (1 + F.col("total_orders")), 6))
    return stats.classifier_quality(rows, "is_churned", "score", 0.03)


@query("churn_hash_split")
def churn_hash_split(spark, sf):
    marked = ml.hash_split(_labelled(Lake(spark, sf)), "customer_id")
    return marked.groupBy("is_churned", "is_test").agg(F.count(F.lit(1)).alias("n"))


@query(
    "churn_stratified_split",
    """SELECT customer_id, is_churned, row_number() OVER (PARTITION BY is_churned ORDER BY md5(customer_id || ':42'), customer_id)
              <= floor(count(*) OVER (PARTITION BY is_churned) * 0.2 + 0.5) AS is_test FROM churn_rows""",
)
def churn_stratified_split(spark, sf):
    marked = ml.stratified_split(_labelled(Lake(spark, sf)), "customer_id", "is_churned")
    return marked.select("customer_id", "is_churned", "is_test")


_CONTRACT = T.StructType().add("customer_id", "string").add("total_spend", "double").add("days_since_last_order", "integer").add("age", "integer")


@query(
    "feature_contract",
    """SELECT c.name AS "column", c.name <> 'age' AS type_ok, c.share AS null_share, c.name <> 'age' AND c.share <= c.most AS ok
       FROM (SELECT unnest([
               {'name': 'customer_id', 'share': round((count(*) - count(customer_id)) / count(*), 6), 'most': 0.0},
               {'name': 'total_spend', 'share': round((count(*) - count(total_spend)) / count(*), 6), 'most': 0.0},
               {'name': 'days_since_last_order', 'share': round((count(*) - count(days_since_last_order)) / count(*), 6), 'most': 0.01},
               {'name': 'age', 'share': NULL, 'most': 0.0}]) AS c FROM customer_facts)""",
)
def feature_contract(spark, sf):
    """Columns, types and shares of NULL against a contract that one column and one share break."""
    return quality.contract_report(Lake(spark, sf).customer_metrics, _CONTRACT, {"days_since_last_order": 0.01})


@query("churn_model_quality")
def churn_model_quality(spark, sf):
    """Boosted trees trained on four fifths of the customers, judged on the rest.

    The feature that makes the label is left out, so the figures are honest.
    """
    columns = [c for c in ml.CHURN_FEATURES if c != "days_since_last_order"]
    rows = ml.stratified_split(_labelled(Lake(spark, sf)), "customer_id", "is_churned").persist()
    model = ml.train_churn(rows.where("NOT is_test"), columns)
    scored = ml.score_churn(model, rows.where("is_test"), columns)
    return stats.classifier_quality(scored, "is_churned", "churn_probability")


@query("forecast_model_quality")
def forecast_model_quality(spark, sf):
    rows = features.time_split(features.forecast_features(_series(spark, sf))).persist()
    model = ml.train_forecast(rows.where("NOT is_test"))
    scored = ml.score_forecast(model, rows.where("is_test"))
    return stats.regression_quality(scored, "net_revenue", "predicted_revenue")


@query("forecast_next_days")
def forecast_next_days(spark, sf):
    lake = Lake(spark, sf)
    daily = _series(spark, sf).persist()
    model = ml.train_forecast(features.forecast_features(daily))
    return ml.forecast(model, daily, lake.as_of.date(), 7)


@query(
    "customer_scores_by_batches",
    f"""SELECT customer_id, {rounded("least(1.0, total_spend / 1000000.0)", 4)} AS churn_probability
        FROM customer_facts""",
)
def customer_scores_by_batches(spark, sf):
    rows = Lake(spark, sf).customer_metrics.select("customer_id", "total_spend")
    scored = ml.score_with(
        rows,
        lambda b: b.assign(churn_probability=(b["total_spend"] / 1_000_000).clip(upper=1.0))[
            ["customer_id", "churn_probability"]
        ],
        "customer_id STRING, churn_probability DOUBLE",
    )
    return scored.withColumn("churn_probability", money("churn_probability", 4))


# --- drift ------------------------------------------------------------------

_PSI_FEATURES = {"price": "l_extendedprice", "quantity": "l_quantity", "discount": "l_discount"}
CTES["drift_rows"] = """
    SELECT l_shipdate < (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 1000 DAY AS is_baseline,
           l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 30 DAY AS is_current,
           l_extendedprice AS price, l_quantity AS quantity, l_discount AS discount,
           CASE WHEN l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 30 DAY
                THEN l_extendedprice * 1.5 ELSE l_extendedprice END AS shifted FROM lineitem"""
_PSI_NAMES = ["price", "quantity", "discount", "shifted"]
_PSI_LONG = " UNION ALL ".join(
    f"SELECT '{n}' AS feature, is_baseline, is_current, {n} AS value FROM drift_rows WHERE is_baseline OR is_current"
    for n in _PSI_NAMES
)
CTES["drift_long"] = _PSI_LONG
CTES["drift_bins"] = """
    SELECT d.feature, len(list_filter(e.edges, lambda x: x <= d.value)) AS bin,
           count(CASE WHEN is_baseline THEN 1 END) AS nb, count(CASE WHEN is_current THEN 1 END) AS nc
    FROM drift_long d JOIN (
        SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
        FROM drift_long WHERE is_baseline GROUP BY 1) e ON d.feature = e.feature
    GROUP BY 1, 2"""
CTES["drift_psi"] = """
    SELECT feature, CAST(sum(nb) AS BIGINT) AS baseline_rows, CAST(sum(nc) AS BIGINT) AS current_rows,
           round(sum((a - e) * ln(a / e)), 4) AS psi
    FROM (SELECT *, CASE WHEN nb = 0 THEN 0.0001 ELSE nb / sum(nb) OVER (PARTITION BY feature) END AS e,
                 CASE WHEN nc = 0 THEN 0.0001 ELSE nc / sum(nc) OVER (PARTITION BY feature) END AS a
          FROM drift_bins) GROUP BY 1"""


def _drift(spark, sf):
    lines = testdata.table(spark, sf, "lineitem")
    as_of = testdata.latest(lines, "l_shipdate")
    windows = stats.drift_windows(lines, "l_shipdate", as_of - timedelta(days=1000), as_of)
    shifted = F.when(F.col("is_current"), F.col("l_extendedprice") * 1.5).otherwise(F.col("l_extendedprice"))
    rows = windows.select(
        "is_baseline",
        "is_current",
        *[F.col(c).alias(n) for n, c in _PSI_FEATURES.items()],
        shifted.alias("shifted"),
    )
    return stats.population_stability(rows, _PSI_NAMES)


@query(
    "feature_drift",
    """SELECT *, CASE WHEN psi > 0.2 THEN 'high' WHEN psi > 0.1 THEN 'moderate' ELSE 'none' END AS drift
       FROM drift_psi""",
)
def feature_drift(spark, sf):
    return _drift(spark, sf)


@query(
    "retrain_decision",
    """SELECT COALESCE(bool_or(psi > 0.2), FALSE) AS retrain,
              COALESCE(string_agg(CASE WHEN psi > 0.2 THEN feature END, ',' ORDER BY feature), '') AS drifted_features
       FROM drift_psi""",
)
def retrain_decision(spark, sf):
    return stats.retrain_decision(_drift(spark, sf))
