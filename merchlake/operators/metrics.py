"""Parameterised business metrics, chart series and threshold alerts.

Every metric is data: which table, which date column, what to group by, what
to compute, how to order. One function turns such a description into a plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.functions.scalars import as_day, in_period, money, ratio


@dataclass(frozen=True)
class Metric:
    table: str
    when: str | None
    group: tuple[str, Callable[[], Column]]
    values: Mapping[str, Callable[[], Column]]
    order: tuple[Callable[[], Column], ...] = field(default=())


def _day_of(column: str) -> Callable[[], Column]:
    return lambda: F.to_date(column)


def _newest() -> Column:
    return F.desc("day")


def _rows() -> Column:
    return F.count(F.lit(1))


# `order_count` of "revenue" counts daily rows, as its name does not say;
# `orders_total` beside it counts orders.
METRICS: dict[str, Metric] = {
    "revenue": Metric(
        table="revenue_daily",
        when="order_date",
        group=("day", _day_of("order_date")),
        values={
            "total_revenue_eur": lambda: money(F.sum("total_revenue")),
            "order_count": _rows,
            "orders_total": lambda: F.sum("order_count"),
        },
        order=(_newest,),
    ),
    "orders": Metric(
        table="fct_orders",
        when="order_date",
        group=("day", _day_of("order_date")),
        values={"order_count": _rows, "unique_customers": lambda: F.count_distinct("customer_id")},
        order=(_newest,),
    ),
    "customers": Metric(
        table="customer_metrics",
        when=None,
        group=("churn_risk_segment", lambda: F.col("churn_risk_segment")),
        values={
            "customer_count": _rows,
            "avg_churn_prob": lambda: money(F.avg("predicted_churn_prob"), 3),
            "avg_revenue_90d": lambda: money(F.avg("total_revenue_90d")),
        },
        order=(lambda: F.desc("avg_churn_prob"), lambda: F.asc("churn_risk_segment")),
    ),
    "products": Metric(
        table="product_performance",
        when="snapshot_date",
        group=("product_name", lambda: F.col("product_name")),
        values={
            "total_revenue_eur": lambda: money(F.sum("total_revenue")),
            "units_sold": lambda: F.sum("units_sold"),
            "avg_return_rate": lambda: money(F.avg("return_rate"), 3),
        },
        order=(lambda: F.desc("total_revenue_eur"), lambda: F.asc("product_name")),
    ),
    "returns": Metric(
        table="fct_returns",
        when="return_date",
        group=("day", _day_of("return_date")),
        values={"return_count": _rows, "refund_total_eur": lambda: money(F.sum("refund_amount"))},
        order=(_newest,),
    ),
}


def metric(
    tables: Mapping[str, DataFrame],
    name: str,
    period: str = "last 7 days",
    limit: int = 10,
    as_of: date | datetime | None = None,
    bounded: bool = False,
) -> DataFrame:
    """One named metric over a named period, newest or largest first, top `limit` rows."""
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}, choose from {sorted(METRICS)}")
    spec = METRICS[name]
    rows = tables[spec.table]
    if spec.when is not None:
        rows = rows.where(in_period(spec.when, period, as_of, bounded))
    label, grouping = spec.group
    grouped = rows.groupBy(grouping().alias(label)).agg(*[make().alias(n) for n, make in spec.values.items()])
    return grouped.orderBy(*[o() for o in spec.order]).limit(limit)


def segments_by_size(customer_metrics: DataFrame, limit: int = 10) -> DataFrame:
    """The customer metric with the biggest segment first."""
    counted = customer_metrics.groupBy("churn_risk_segment").agg(
        _rows().alias("customer_count"), money(F.avg("predicted_churn_prob"), 3).alias("avg_churn_prob")
    )
    return counted.orderBy(F.desc("customer_count"), "churn_risk_segment").limit(limit)


def segment_listing(segments: DataFrame, limit: int = 10) -> DataFrame:
    """Rows of an already aggregated segment table, most at risk first."""
    shown = segments.select(
        "churn_risk_segment", "customer_count", money("predicted_churn_prob", 3).alias("avg_churn_prob")
    )
    return shown.orderBy(F.desc("avg_churn_prob"), "churn_risk_segment").limit(limit)


def recent_revenue(revenue: DataFrame, period: str, as_of, limit: int = 14) -> DataFrame:
    rows = revenue.where(in_period("order_date", period, as_of))
    shown = rows.select(
        F.col("order_date").cast("string").alias("day"), money("total_revenue").alias("revenue_eur"), "order_count"
    )
    return shown.orderBy(F.desc("day")).limit(limit)


def top_products(performance: DataFrame, period: str, as_of, limit: int = 10) -> DataFrame:
    rows = performance.where(in_period("snapshot_date", period, as_of))
    summed = rows.groupBy("product_name").agg(
        F.sum("units_sold").alias("total_units"), money(F.sum("total_revenue")).alias("revenue_eur")
    )
    return summed.orderBy(F.desc("revenue_eur"), "product_name").limit(limit)


def most_returned(performance: DataFrame, limit: int = 10) -> DataFrame:
    """Products with the highest return rate."""
    return performance.select("product_id", "product_name", "category", "return_rate_pct").orderBy(
        F.desc("return_rate_pct"), "product_id"
    ).limit(limit)


# Chart series: source table, date column, value, axis title (titles are fixed values).
CHARTS: dict[str, tuple[str, str, Callable[[], Column], str]] = {
    "revenue": ("revenue_daily", "order_date", lambda: money(F.sum("total_revenue")), "Revenue (EUR)"),
    "orders": ("fct_orders", "order_date", _rows, "Order Count"),
    "returns": ("fct_returns", "return_date", _rows, "Return Count"),
    "return_rate": (
        "product_performance",
        "snapshot_date",
        lambda: money(F.avg("return_rate") * 100),
        "Avg Return Rate (%)",
    ),
}
MARKS = {"bar": "bar", "line": "line", "pie": "arc"}


def chart_series(tables: Mapping[str, DataFrame], name: str, period: str, as_of) -> DataFrame:
    """(x, y) points per day; unknown names show revenue, missing values are 0."""
    table, when, value, _ = CHARTS.get(name, CHARTS["revenue"])
    daily = tables[table].where(in_period(when, period, as_of)).groupBy(F.to_date(when).alias("_day")).agg(
        value().cast("double").alias("_y")
    )
    return daily.select(
        F.col("_day").cast("string").alias("x"), F.coalesce(F.col("_y"), F.lit(0.0)).alias("y")
    ).orderBy("x")


def chart_spec(series: DataFrame, name: str, mark: str, period: str) -> DataFrame:
    """A Vega-Lite description of a series as one JSON string; a series has one point per day."""
    title = CHARTS.get(name, CHARTS["revenue"])[3] if name in CHARTS else name
    # As DECIMAL, large values are written in full rather than with an exponent.
    point = F.struct("x", F.col("y").cast("decimal(38,2)").alias("y"))
    points = F.sort_array(F.collect_list(point)).alias("values")
    axis = lambda column, kind, text: F.struct(
        F.lit(column).alias("field"), F.lit(kind).alias("type"), F.lit(text).alias("title")
    )
    body = F.struct(
        F.lit("https://vega.github.io/schema/vega-lite/v5.json").alias("$schema"),
        F.lit(f"{title} — {period}").alias("title"),
        F.lit(MARKS.get(mark, "bar")).alias("mark"),
        F.struct("values").alias("data"),
        F.struct(axis("x", "ordinal", "Date").alias("x"), axis("y", "quantitative", title).alias("y")).alias("encoding"),
        F.lit(600).alias("width"),
        F.lit(300).alias("height"),
    )
    return series.agg(points).select(F.to_json(body).alias("spec"))


def kpi_values(tables: Mapping[str, DataFrame], as_of) -> DataFrame:
    """Yesterday's revenue, order count and mean return rate, one (metric, value) row each."""
    today = as_day(as_of)
    yesterday = today - timedelta(days=1)

    def single(table: str, when: str, name: str, value: Column) -> DataFrame:
        day = (F.col(when) >= F.lit(yesterday)) & (F.col(when) < F.lit(today))
        found = tables[table].where(day).agg(value.cast("double").alias("value"))
        return found.select(F.lit(name).alias("metric"), "value")

    return (
        single("revenue_daily", "order_date", "revenue", money(F.sum("total_revenue")))
        .unionByName(single("fct_orders", "order_date", "orders", _rows()))
        .unionByName(
            single("product_performance", "snapshot_date", "return_rate", money(F.avg("return_rate") * 100))
        )
    )


def fired_alerts(values: DataFrame, rules: DataFrame) -> DataFrame:
    """KPI values against rules (name, metric, condition below/above, threshold).

    A missing value fires nothing. Both sides hold a handful of rows.
    """
    below = (F.col("condition") == "below") & (F.col("value") < F.col("threshold"))
    above = (F.col("condition") == "above") & (F.col("value") > F.col("threshold"))
    return rules.join(values, "metric", "left").select(
        "name", "metric", "condition", "threshold", "value", F.coalesce(below | above, F.lit(False)).alias("fired")
    )


def frequent_customers(orders: DataFrame, more_than: int, days: int, as_of: datetime) -> DataFrame:
    """Customers with more than n orders in the last days."""
    recent = orders.where(F.col("order_ts") >= F.lit(as_of - timedelta(days=days)))
    return recent.groupBy("customer_id").agg(_rows().alias("order_count")).where(F.col("order_count") > more_than)


def frequent_at_risk(metrics: DataFrame, scored: DataFrame, more_than: int = 5, segment: str = "High") -> DataFrame:
    """Customers with more than n orders whose churn segment is the given one."""
    risky = scored.where(F.col("churn_risk_segment") == segment).select("customer_id", "predicted_churn_prob")
    return metrics.where(F.col("total_orders") > more_than).select("customer_id", "total_orders").join(
        risky, "customer_id"
    )


def returned_too_often(orders: DataFrame, returns: DataFrame, share: float, start: date, end: date) -> DataFrame:
    """Products whose returns exceed a share of their order lines within [start, end)."""
    inside = lambda c: (F.col(c) >= F.lit(start)) & (F.col(c) < F.lit(end))
    facts = orders.where(inside("order_ts")).select("product_id", F.lit(1).alias("sold")).unionByName(
        returns.where(inside("return_date")).select("product_id", F.lit(1).alias("back")), allowMissingColumns=True
    )
    counted = facts.groupBy("product_id").agg(F.count("sold").alias("order_lines"), F.count("back").alias("returned"))
    rate = ratio(F.col("returned").cast("double"), F.col("order_lines"))
    return counted.where(rate > share).withColumn("return_rate", money(rate, 4))


def large_orders_by_country(orders: DataFrame, customers: DataFrame, amount: float, days: int, as_of: datetime):
    """Order lines above an amount in the last days, counted per country; one row per customer is joined."""
    recent = orders.where((F.col("order_ts") >= F.lit(as_of - timedelta(days=days))) & (F.col("line_total") > amount))
    per_customer = recent.groupBy("customer_id").agg(
        _rows().alias("_n"), F.sum("line_total").alias("_sum")
    )
    placed = per_customer.join(customers.select("customer_id", "country"), "customer_id")
    return placed.groupBy("country").agg(F.sum("_n").alias("order_count"), money(F.sum("_sum")).alias("revenue"))


def business_summary(
    revenue: DataFrame, performance: DataFrame, alerts: DataFrame, forecast: DataFrame | None, period: str, as_of,
    top: int = 5,
) -> DataFrame:
    """One long (section, key, value) table of totals, top products, alerts and forecast."""
    recent = revenue.where(in_period("order_date", period, as_of))
    totals = recent.agg(
        money(F.sum("total_revenue")).alias("total_revenue"),
        F.sum("order_count").cast("double").alias("orders"),
        money(ratio(F.sum("total_revenue"), F.sum("order_count"))).alias("average_order_value"),
    ).select(
        F.lit("revenue").alias("section"),
        F.stack(
            F.lit(3),
            *[x for n in ("total_revenue", "orders", "average_order_value") for x in (F.lit(n), F.col(n))],
        ).alias("key", "value"),
    )
    best = top_products(performance, period, as_of, top).select(
        F.lit("top_products").alias("section"), F.col("product_name").alias("key"), F.col("revenue_eur").alias("value")
    )
    fired = alerts.where("fired").select(
        F.lit("alerts").alias("section"), F.col("name").alias("key"), F.col("value").cast("double").alias("value")
    )
    parts = totals.unionByName(best).unionByName(fired)
    if forecast is not None:
        parts = parts.unionByName(
            forecast.select(
                F.lit("forecast").alias("section"),
                F.col("forecast_date").cast("string").alias("key"),
                F.col("predicted_revenue").alias("value"),
            )
        )
    return parts
