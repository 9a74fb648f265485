"""Aggregates over accepted orders and returns.

Both fact tables are stacked and aggregated in one go: every key is shuffled
once, after map-side aggregation, instead of once per fact table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.functions.ordering import running_weight
from merchlake.functions.scalars import as_day, money, ratio
from merchlake.functions.selection import tiles_of
from merchlake.session import stored

# Lists into which the products of one category and amount are dealt; a list holds a share of them.
LEVEL_BUCKETS = 1024


def _stacked(orders: DataFrame, returns: DataFrame, shared: list[str], of_orders: list[str], of_returns: list[str]):
    return orders.select(*shared, *of_orders).unionByName(
        returns.select(*shared, *of_returns), allowMissingColumns=True
    )


def customer_metrics(orders: DataFrame, returns: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """Orders, spend, recency and returns of every current customer."""
    facts = _stacked(
        orders, returns, ["customer_id"], ["order_id", "line_total", "order_ts"], ["return_id", "refund_amount"]
    )
    per_customer = facts.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("line_total").alias("total_spend"),
        money(F.avg("line_total")).alias("avg_order_value"),
        F.max("order_ts").alias("last_order_ts"),
        F.count("return_id").alias("total_returns"),
        F.sum("refund_amount").alias("total_refunded"),
    )
    people = customers.where("is_current").select("customer_id", "first_name", "last_name", "city", "country")
    recency = F.datediff(F.lit(as_day(as_of)), F.to_date("last_order_ts"))
    amounts = ["total_orders", "total_spend", "avg_order_value", "total_returns", "total_refunded"]
    return (
        people.join(per_customer, "customer_id", "left")
        .withColumn("days_since_last_order", recency)
        .fillna(0, subset=amounts)
    )


def product_performance(orders: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines, revenue and return rate of every product.

    `total_units_sold` counts order lines, not pieces. Every numeric gap,
    the listed price included, becomes 0.
    """
    facts = _stacked(orders, returns, ["product_id"], ["order_id", "line_total", "quantity"], ["return_id"])
    per_product = facts.groupBy("product_id").agg(
        F.count("order_id").alias("total_units_sold"),
        F.sum("line_total").alias("total_revenue"),
        F.avg("quantity").alias("avg_quantity_per_order"),
        F.count("return_id").alias("total_returns"),
    )
    listed = products.select("product_id", "product_name", "category", "unit_price")
    rate = ratio(F.col("total_returns") * 100, F.col("total_units_sold"))
    return (
        listed.join(per_product, "product_id", "left")
        .fillna(0)
        .withColumn("return_rate_pct", F.coalesce(money(rate, 1), F.lit(0.0)))
    )


def revenue_daily(orders: DataFrame, returns: DataFrame, how: str = "left") -> DataFrame:
    """Orders, gross, refunds and net per day.

    By default only days with orders come out, so refunds on other days are
    lost; `how="full"` keeps them.
    """
    sold = orders.select(F.to_date("order_ts").alias("order_date"), "order_id", "line_total")
    refunded = returns.select(F.col("return_date").alias("order_date"), "refund_amount")
    daily = (
        sold.withColumn("_sale", F.lit(1))
        .unionByName(refunded, allowMissingColumns=True)
        .groupBy("order_date")
        .agg(
            F.count("order_id").alias("num_orders"),
            F.sum("line_total").alias("gross_revenue"),
            F.coalesce(F.sum("refund_amount"), F.lit(0.0)).alias("total_refunds"),
            F.count("_sale").alias("_sales"),
        )
    )
    if how == "left":
        daily = daily.where(F.col("_sales") > 0)
    net = F.coalesce(F.col("gross_revenue"), F.lit(0.0)) - F.col("total_refunds")
    return daily.drop("_sales").withColumn("net_revenue", money(net)).orderBy("order_date")


def revenue_by(orders: DataFrame, *keys: str) -> DataFrame:
    """Daily revenue by further columns of the (enriched) orders, e.g. region and category."""
    return (
        orders.withColumn("order_date", F.to_date("order_ts"))
        .groupBy("order_date", *keys)
        .agg(F.count("order_id").alias("num_orders"), money(F.sum("line_total")).alias("revenue"))
    )


def revenue_rollup(orders: DataFrame, *keys: str) -> DataFrame:
    """Revenue at every level of the key hierarchy, with NULL standing for "all"."""
    return orders.rollup(*keys).agg(
        F.count("order_id").alias("num_orders"), money(F.sum("line_total")).alias("revenue")
    )


def month_over_month(orders: DataFrame, *keys: str) -> DataFrame:
    """Monthly revenue per key next to the month before it, and whether it declined.

    The previous month is joined as a shifted copy of the monthly totals, so a
    key without sales in the month before has no previous value.
    """
    monthly = (
        orders.groupBy(*keys, F.trunc(F.to_date("order_ts"), "month").alias("month"))
        .agg(F.sum("line_total").alias("_sum"))
    )
    shifted = monthly.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.add_months("month", 1).alias("_month"),
        F.col("_sum").alias("_previous"),
    )
    match = F.col("month") == F.col("_month")
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_{key}"))
    change = ratio((F.col("_sum") - F.col("_previous")) * 100, F.col("_previous"))
    return monthly.join(shifted, match, "left").select(
        *keys,
        "month",
        money("_sum").alias("revenue"),
        money("_previous").alias("previous_revenue"),
        money(change, 1).alias("change_pct"),
        (F.col("_sum") < F.col("_previous")).alias("declined"),
    )


def daily_product_sales(orders: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """Per product and day: pieces, revenue and the share of the day's lines that came back."""
    facts = _stacked(
        orders.withColumn("snapshot_date", F.to_date("order_ts")),
        returns.withColumnRenamed("return_date", "snapshot_date"),
        ["product_id", "snapshot_date"],
        ["order_id", "quantity", "line_total"],
        ["return_id"],
    )
    daily = facts.groupBy("product_id", "snapshot_date").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("line_total").alias("total_revenue"),
        ratio(F.count("return_id"), F.count("order_id")).alias("return_rate"),
        F.count("order_id").alias("_lines"),
    )
    named = products.select("product_id", "product_name", "category")
    return daily.where(F.col("_lines") > 0).drop("_lines").join(named, "product_id")


def customer_rfm(metrics: DataFrame, tiles: int = 5) -> DataFrame:
    """Recency, frequency and monetary scores (5 is best) of customers with orders.

    Ties are broken by customer id. The borders of all three rankings are looked
    up from counts (`selection.tiles_of`); the customers themselves are neither
    sorted nor shuffled.
    """
    base = stored(metrics.where(F.col("total_orders") > 0).select(
        "customer_id", "days_since_last_order", "total_orders", "total_spend"
    ), "rfm")
    orderings = {
        "r_score": F.coalesce(-F.col("days_since_last_order"), F.lit(float("inf"))),
        "f_score": F.col("total_orders"),
        "m_score": F.col("total_spend"),
    }
    code = F.concat(*[F.col(s).cast("string") for s in orderings])
    return tiles_of(base, orderings, "customer_id", tiles).withColumn("rfm_code", code)


def customer_features(orders: DataFrame, as_of: datetime, margin: float = 1.0) -> DataFrame:
    """days_since_order, order_frequency_30d, avg_order_value and a spend-based lifetime value.

    `clv_estimate` is average order value × orders per active year × margin; a
    customer active less than a year counts as one year.
    """
    moment = F.lit(as_of).cast("timestamp")
    recent = F.col("order_ts") >= moment - F.expr("INTERVAL 30 DAYS")
    active_years = F.greatest(
        F.datediff(F.max("order_ts"), F.min("order_ts")) / F.lit(365.0), F.lit(1.0)
    )
    return (
        orders.groupBy("customer_id")
        .agg(
            F.datediff(moment, F.max("order_ts")).alias("days_since_order"),
            F.count(F.when(recent, 1)).alias("order_frequency_30d"),
            money(F.avg("line_total")).alias("avg_order_value"),
            money(F.sum("line_total") / active_years * margin).alias("clv_estimate"),
        )
    )


def product_features(orders: DataFrame, products: DataFrame, as_of: datetime, pieces: int | None = None) -> DataFrame:
    """gmv_30d, units_sold_30d, trend_score (last 30 days over the 30 before) and rank in the category.

    The rank is 1 + the number of products of the category with a higher
    gmv_30d, computed range by range.
    """
    moment = F.lit(as_of).cast("timestamp")
    now = F.col("order_ts") >= moment - F.expr("INTERVAL 30 DAYS")
    earlier = (F.col("order_ts") >= moment - F.expr("INTERVAL 60 DAYS")) & ~now
    sums = (
        orders.where(F.col("order_ts") >= moment - F.expr("INTERVAL 60 DAYS"))
        .groupBy("product_id")
        .agg(
            F.sum(F.when(now, F.col("line_total"))).alias("_now"),
            F.sum(F.when(now, F.col("quantity"))).alias("units_sold_30d"),
            F.sum(F.when(earlier, F.col("line_total"))).alias("_earlier"),
        )
    )
    base = products.select("product_id", "category").join(sums, "product_id", "left").select(
        "product_id",
        "category",
        F.coalesce(money("_now"), F.lit(0.0)).alias("gmv_30d"),
        F.coalesce(F.col("units_sold_30d"), F.lit(0)).alias("units_sold_30d"),
        money(ratio(F.coalesce(F.col("_now"), F.lit(0.0)), F.col("_earlier")), 4).alias("trend_score"),
    )
    # Money in whole cents; the products of a category with the same amount are one level, kept as a list of rows per
    # bucket of ids, so that the level of all products without sales is no single row.
    cents = F.round(F.col("gmv_30d") * 100).cast("bigint")
    buckets = base.withColumn("_cents", cents).groupBy(
        "category", "_cents", F.pmod(F.xxhash64("product_id"), F.lit(LEVEL_BUCKETS)).alias("_bucket")
    ).agg(F.count(F.lit(1)).alias("_n"), F.collect_list(F.struct("product_id", "gmv_30d", "units_sold_30d", "trend_score")).alias("_rows"))
    ranked = running_weight(buckets, ["category"], [F.desc("_cents"), "_bucket"], "_n", before="_before", pieces=pieces)
    # A level's rank is that of its first bucket.
    firsts = ranked.groupBy(F.col("category").alias("_c"), F.col("_cents").alias("_l")).agg(F.min("_before").alias("_higher"))
    ranks = ranked.join(firsts, F.col("category").eqNullSafe(F.col("_c")) & (F.col("_cents") == F.col("_l")))
    return ranks.select("category", (F.col("_higher") + 1).alias("category_rank"), F.inline("_rows")).select(
        "product_id", "category", "gmv_30d", "units_sold_30d", "trend_score", "category_rank"
    )


def churn_scores(metrics: DataFrame, orders: DataFrame, as_of: datetime, scores: DataFrame) -> DataFrame:
    """Customer table with churn probability, risk segment and revenue of the last 90 days."""
    recent = (
        orders.where(F.col("order_ts") >= F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 90 DAYS"))
        .groupBy("customer_id")
        .agg(F.sum("line_total").alias("total_revenue_90d"))
    )
    return (
        metrics.select("customer_id")
        .join(scores.select("customer_id", "predicted_churn_prob"), "customer_id")
        .join(recent, "customer_id", "left")
        .withColumn("total_revenue_90d", F.coalesce("total_revenue_90d", F.lit(0.0)))
        .withColumn("churn_risk_segment", risk_segment(F.col("predicted_churn_prob")))
    )


def risk_segment(probability: Column, low: float = 0.33, high: float = 0.66) -> Column:
    """Low / Medium / High by probability; the limits are ours and can be set."""
    return F.when(probability >= high, "High").when(probability >= low, "Medium").otherwise("Low")
