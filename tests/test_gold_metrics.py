from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from merchlake.functions.scalars import in_period, money, period_end, period_start
from merchlake.operators import gold, metrics

AS_OF = datetime(2024, 5, 10)


@pytest.fixture(scope="module")
def shop(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "p1", 2, 5.0, 10.0, datetime(2024, 5, 1, 9)), ("o2", "c1", "p1", 1, 5.0, 5.005, datetime(2024, 5, 1, 23)),
         ("o3", "c2", "p2", 1, 7.0, 7.0, datetime(2024, 5, 3))],
        "order_id STRING, customer_id STRING, product_id STRING, quantity INT, unit_price DOUBLE, line_total DOUBLE, "
        "order_ts TIMESTAMP",
    )
    returns = spark.createDataFrame(
        [("r1", "o1", "c1", "p1", date(2024, 5, 1), 4.0), ("r2", "o1", "c1", "p1", date(2024, 5, 2), 1.0),
         ("r3", "o3", "c3", "p3", None, 2.0)],
        "return_id STRING, order_id STRING, customer_id STRING, product_id STRING, return_date DATE, refund_amount DOUBLE",
    )
    customers = spark.createDataFrame(
        [(c, "f", "l", "x", "NL", cur) for c, cur in (("c1", True), ("c2", True), ("c3", True), ("c4", False))],
        "customer_id STRING, first_name STRING, last_name STRING, city STRING, country STRING, is_current BOOLEAN",
    )
    products = spark.createDataFrame(
        [("p1", "One", "A", 5.0), ("p2", "Two", "A", None), ("p3", "Three", "B", 1.0)],
        "product_id STRING, product_name STRING, category STRING, unit_price DOUBLE",
    )
    return orders, returns, customers, products


def test_customer_metrics(shop):
    orders, returns, customers, _ = shop
    got = {r["customer_id"]: r for r in gold.customer_metrics(orders, returns, customers, AS_OF).collect()}
    assert set(got) == {"c1", "c2", "c3"}
    one, three = got["c1"], got["c3"]
    assert (one["total_orders"], one["avg_order_value"], one["days_since_last_order"]) == (2, 7.5, 9)
    assert (one["total_returns"], one["total_refunded"]) == (2, 5.0)
    assert (three["total_orders"], three["total_spend"], three["total_returns"]) == (0, 0.0, 1)
    assert three["days_since_last_order"] is None and three["last_order_ts"] is None


def test_product_performance(shop):
    orders, returns, _, products = shop
    got = {r["product_id"]: r for r in gold.product_performance(orders, returns, products).collect()}
    assert (got["p1"]["total_units_sold"], got["p1"]["avg_quantity_per_order"], got["p1"]["return_rate_pct"]) == (2, 1.5, 100.0)
    assert (got["p2"]["unit_price"], got["p2"]["return_rate_pct"]) == (0.0, 0.0)
    assert (got["p3"]["total_units_sold"], got["p3"]["total_returns"], got["p3"]["return_rate_pct"]) == (0, 1, 0.0)


def test_daily_revenue_left_and_full(shop):
    orders, returns, _, _ = shop
    left = gold.revenue_daily(orders, returns).collect()
    assert [(r["order_date"], r["num_orders"], r["total_refunds"]) for r in left] == [
        (date(2024, 5, 1), 2, 4.0), (date(2024, 5, 3), 1, 0.0)
    ]
    full = gold.revenue_daily(orders, returns, how="full").collect()
    assert {r["order_date"]: r["net_revenue"] for r in full} == {
        None: -2.0, date(2024, 5, 1): 11.01, date(2024, 5, 2): -1.0, date(2024, 5, 3): 7.0
    }


def test_one_shuffle_per_key_for_both_fact_tables(shop):
    orders, returns, customers, _ = shop
    plan = gold.revenue_daily(orders, returns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_risk_segments_and_features(spark, shop):
    df = spark.createDataFrame([(0.1,), (0.33,), (0.66,)], "p DOUBLE")
    assert [r[0] for r in df.select(gold.risk_segment(F.col("p"))).collect()] == ["Low", "Medium", "High"]
    orders, _, _, products = shop
    got = {r["product_id"]: r for r in gold.product_features(orders, products, AS_OF, pieces=2).collect()}
    assert (got["p1"]["category_rank"], got["p2"]["category_rank"], got["p3"]["category_rank"]) == (1, 2, 1)
    assert got["p3"]["gmv_30d"] == 0.0 and got["p3"]["trend_score"] is None
    unsorted = spark.createDataFrame([("p1", None), ("p2", None), ("n1", None), ("n2", None)], "product_id STRING, category STRING")
    ranks = {r["product_id"]: r["category_rank"] for r in gold.product_features(orders, unsorted, AS_OF, pieces=2).collect()}
    assert ranks == {"p1": 1, "p2": 2, "n1": 3, "n2": 3}


@pytest.mark.parametrize(
    "period, start",
    [("today", date(2024, 3, 1)), (" Yesterday ", date(2024, 2, 29)), ("LAST 7 DAYS", date(2024, 2, 23)),
     ("last 14 days", date(2024, 2, 16)), ("last 30 days", date(2024, 1, 31)), ("this month", date(2024, 3, 1)),
     ("last month", date(2024, 2, 1)), ("whenever", date(2024, 2, 23)), (None, date(2024, 2, 23))],
)
def test_period_start(period, start):
    assert period_start(period, datetime(2024, 3, 1, 15)) == start


def test_period_ends():
    assert period_end("yesterday", date(2024, 3, 1)) == date(2024, 3, 1)
    assert period_end("last month", date(2024, 3, 9)) == date(2024, 3, 1)
    assert period_end("last 7 days", date(2024, 3, 1)) == date(2024, 3, 2)


def test_periods_are_open_ended_unless_bounded(spark):
    df = spark.createDataFrame([(date(2024, 2, 29),), (date(2024, 3, 1),), (date(2024, 4, 1),)], "d DATE")
    assert df.where(in_period("d", "yesterday", date(2024, 3, 1))).count() == 3
    assert df.where(in_period("d", "yesterday", date(2024, 3, 1), bounded=True)).count() == 1


def test_money_rounds_half_up_in_spite_of_wobble(spark):
    df = spark.createDataFrame([(1.005,), (1.0049999999999,), (2.675,), (-1.005,)], "x DOUBLE")
    assert [r[0] for r in df.select(money("x")).collect()] == [1.01, 1.01, 2.68, -1.01]


def test_unknown_metric_is_refused():
    with pytest.raises(ValueError):
        metrics.metric({}, "weather")


def test_alerts(spark):
    values = spark.createDataFrame([("revenue", 10.0), ("orders", 3.0), ("return_rate", None)], "metric STRING, value DOUBLE")
    rules = spark.createDataFrame(
        [("a", "revenue", "below", 11.0), ("b", "revenue", "below", 10.0), ("c", "orders", "above", 2.0),
         ("d", "return_rate", "above", 0.0)],
        "name STRING, metric STRING, condition STRING, threshold DOUBLE",
    )
    assert {r["name"]: r["fired"] for r in metrics.fired_alerts(values, rules).collect()} == {
        "a": True, "b": False, "c": True, "d": False
    }


def test_chart_series_fills_missing_values(spark):
    tables = {"revenue_daily": spark.createDataFrame([(date(2024, 5, 9), None, 1)], "order_date DATE, total_revenue DOUBLE, order_count INT")}
    series = metrics.chart_series(tables, "no such metric", "today", date(2024, 5, 9))
    assert rows(series) == [("2024-05-09", 0.0)]
    spec = metrics.chart_spec(series, "revenue", "pie", "today").first()["spec"]
    assert '"mark":"arc"' in spec and '"title":"Revenue (EUR) — today"' in spec
