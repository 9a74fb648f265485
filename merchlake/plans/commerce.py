"""Orders and returns from raw rows to gold tables, metrics and alerts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.functions.joins import estimated_bytes, spread_join
from merchlake.operators import gold, metrics, quality
from merchlake.plans.registry import CTES, day, moment, query, rounded
from merchlake.session import scratch_path
from merchlake.sources import files, testdata


# Facts built by this process: (application, folder, name) -> (state of the source files, path).
_BUILT: dict[tuple[str, str, str], tuple[tuple, str]] = {}
SOURCES = ("orders", "lineitem", "customer", "part")


class Lake:
    """The commerce tables of one test-data folder, each built on first use.

    Accepted orders and returns are written once per session, folder and state of
    its files, below the shared scratch folder, and read from there by everything
    that builds on them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def _fact(self, name: str, make) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        state = tuple(files.state(self.spark, f"{self.sf_dir.rstrip('/')}/{t}.parquet") for t in SOURCES)
        built, path = _BUILT.get(key, (None, ""))
        if built != state or not files.state(self.spark, path):
            path = scratch_path(self.spark, name)
            # Written once and read in part by each query: the smaller files are worth the time.
            make().write.option("compression", "zstd").parquet(path)
            _BUILT[key] = (state, path)
        return self.spark.read.parquet(path)

    @property
    def as_of(self):
        if not hasattr(self, "_as_of"):
            self._as_of = testdata.latest(testdata.table(self.spark, self.sf_dir, "orders"), "o_orderdate")
        return self._as_of

    @property
    def customers(self):
        return self._once(
            "customers",
            lambda: testdata.customers(self.spark, self.sf_dir).withColumn("is_current", F.lit(True)),
        )

    @property
    def customer_ids(self):
        people = testdata.table(self.spark, self.sf_dir, "customer")
        return people.select(F.col("c_custkey").cast("string").alias("customer_id"))

    @property
    def customer_bytes(self) -> int:
        """Bound for the customer table: nation and region add two short names to each row."""
        return 4 * estimated_bytes(testdata.table(self.spark, self.sf_dir, "customer"))

    @property
    def products(self):
        return self._once("products", lambda: testdata.products(self.spark, self.sf_dir))

    @property
    def checked_orders(self):
        return self._once(
            "checked_orders",
            lambda: quality.check_orders(
                testdata.orders_raw(self.spark, self.sf_dir),
                self.customer_ids,
                self.products.select("product_id"),
            ),
        )

    @property
    def orders(self):
        return self._once("orders", lambda: self._fact("orders", lambda: quality.accepted_orders(self.checked_orders)))

    @property
    def checked_returns(self):
        return self._once(
            "checked_returns",
            lambda: quality.check_returns(
                testdata.returns_raw(self.spark, self.sf_dir), self.orders.select("order_id")
            ),
        )

    @property
    def returns(self):
        return self._once("returns", lambda: self._fact("returns", lambda: quality.accepted_returns(self.checked_returns)))

    @property
    def revenue(self):
        return self._once("revenue", lambda: gold.revenue_daily(self.orders, self.returns))

    @property
    def customer_metrics(self):
        return self._once(
            "customer_metrics", lambda: gold.customer_metrics(self.orders, self.returns, self.customers, self.as_of)
        )

    @property
    def product_performance(self):
        return self._once(
            "product_performance", lambda: gold.product_performance(self.orders, self.returns, self.products)
        )

    @property
    def product_days(self):
        return self._once(
            "product_days", lambda: gold.daily_product_sales(self.orders, self.returns, self.products)
        )

    @property
    def scores(self):
        """A churn probability per customer that grows with the days since the last order."""
        days = F.coalesce(F.col("days_since_last_order"), F.lit(0))
        return self.customer_metrics.select(
            "customer_id", F.least(F.lit(1.0), days / F.lit(90.0)).alias("predicted_churn_prob")
        )

    @property
    def scored_customers(self):
        return self._once(
            "scored_customers",
            lambda: gold.churn_scores(self.customer_metrics, self.orders, self.as_of, self.scores),
        )

    @property
    def serving(self) -> dict[str, DataFrame]:
        """The tables under the names and columns that the metrics read."""
        return {
            "revenue_daily": self.revenue.select(
                "order_date",
                F.col("net_revenue").alias("total_revenue"),
                F.col("num_orders").alias("order_count"),
            ),
            "fct_orders": self.orders.withColumnRenamed("order_ts", "order_date"),
            "fct_returns": self.returns,
            "product_performance": self.product_days,
            "customer_metrics": self.scored_customers,
        }


CTES["clock"] = "SELECT max(o_orderdate) AS as_of FROM orders"
CTES["checked_orders"] = """
    SELECT r.*, try_strptime(r.order_ts, '%Y-%m-%dT%H:%M:%S') AS order_ts_parsed,
           (r.order_id IS NULL) AS bad_id, (c.customer_id IS NULL) AS bad_customer,
           (p.product_id IS NULL) AS bad_product, NOT COALESCE(r.unit_price > 0, FALSE) AS bad_price,
           (try_strptime(r.order_ts, '%Y-%m-%dT%H:%M:%S') IS NULL) AS bad_time
    FROM orders_raw r
    LEFT JOIN (SELECT DISTINCT customer_id FROM customers) c ON r.customer_id = c.customer_id
    LEFT JOIN (SELECT DISTINCT product_id FROM products) p ON r.product_id = p.product_id"""
CTES["good_orders"] = """
    SELECT order_id, customer_id, product_id, quantity, unit_price, quantity * unit_price AS line_total,
           order_ts_parsed AS order_ts
    FROM checked_orders
    WHERE NOT (bad_id OR bad_customer OR bad_product OR bad_price OR bad_time)"""
CTES["checked_returns"] = """
    SELECT r.*, CAST(try_strptime(r.return_date, '%Y-%m-%d') AS DATE) AS return_date_parsed,
           (r.return_id IS NULL) AS bad_id, (o.order_id IS NULL) AS bad_order,
           NOT COALESCE(r.refund_amount >= 0, FALSE) AS bad_refund
    FROM returns_raw r LEFT JOIN (SELECT DISTINCT order_id FROM good_orders) o ON r.order_id = o.order_id"""
CTES["good_returns"] = """
    SELECT return_id, order_id, customer_id, product_id, return_date_parsed AS return_date, reason_code,
           refund_amount
    FROM checked_returns WHERE NOT (bad_id OR bad_order OR bad_refund)"""
CTES["sold_days"] = """
    SELECT CAST(order_ts AS DATE) AS order_date, count(order_id) AS num_orders, sum(line_total) AS gross_revenue
    FROM good_orders GROUP BY 1"""
CTES["refund_days"] = """
    SELECT return_date AS order_date, sum(refund_amount) AS total_refunds FROM good_returns GROUP BY 1"""
CTES["revenue_days"] = f"""
    SELECT s.order_date, num_orders, gross_revenue, COALESCE(total_refunds, 0) AS total_refunds,
           {rounded("gross_revenue - COALESCE(total_refunds, 0)")} AS net_revenue
    FROM sold_days s LEFT JOIN refund_days r ON s.order_date = r.order_date"""
CTES["customer_facts"] = f"""
    SELECT c.customer_id, c.first_name, c.last_name, c.city, c.country,
           COALESCE(o.n, 0) AS total_orders, COALESCE(o.spend, 0) AS total_spend,
           COALESCE(o.mean, 0) AS avg_order_value, o.last_order_ts,
           date_diff('day', CAST(o.last_order_ts AS DATE), CAST((SELECT as_of FROM clock) AS DATE))
               AS days_since_last_order,
           COALESCE(r.n, 0) AS total_returns, COALESCE(r.refunded, 0) AS total_refunded
    FROM customers c
    LEFT JOIN (SELECT customer_id, count(order_id) AS n, sum(line_total) AS spend,
                      {rounded("avg(line_total)")} AS mean, max(order_ts) AS last_order_ts
               FROM good_orders GROUP BY 1) o ON c.customer_id = o.customer_id
    LEFT JOIN (SELECT customer_id, count(return_id) AS n, sum(refund_amount) AS refunded
               FROM good_returns GROUP BY 1) r ON c.customer_id = r.customer_id"""
CTES["product_facts"] = f"""
    SELECT p.product_id, p.product_name, p.category, COALESCE(p.unit_price, 0) AS unit_price,
           COALESCE(o.n, 0) AS total_units_sold, COALESCE(o.revenue, 0) AS total_revenue,
           COALESCE(o.pieces, 0) AS avg_quantity_per_order, COALESCE(r.n, 0) AS total_returns,
           CASE WHEN COALESCE(o.n, 0) > 0
                THEN {rounded("COALESCE(r.n, 0) * 100.0 / o.n", 1)} ELSE 0.0 END AS return_rate_pct
    FROM products p
    LEFT JOIN (SELECT product_id, count(order_id) AS n, sum(line_total) AS revenue, avg(quantity) AS pieces
               FROM good_orders GROUP BY 1) o ON p.product_id = o.product_id
    LEFT JOIN (SELECT product_id, count(return_id) AS n FROM good_returns GROUP BY 1) r
           ON p.product_id = r.product_id"""
CTES["product_days"] = """
    SELECT o.product_id, o.snapshot_date, o.units_sold, o.total_revenue,
           COALESCE(r.n, 0) / o.n AS return_rate, p.product_name, p.category
    FROM (SELECT product_id, CAST(order_ts AS DATE) AS snapshot_date, sum(quantity) AS units_sold,
                 sum(line_total) AS total_revenue, count(order_id) AS n
          FROM good_orders GROUP BY 1, 2) o
    LEFT JOIN (SELECT product_id, return_date, count(return_id) AS n FROM good_returns GROUP BY 1, 2) r
           ON o.product_id = r.product_id AND o.snapshot_date = r.return_date
    JOIN products p ON o.product_id = p.product_id"""
CTES["scored_customers"] = """
    SELECT customer_id, predicted_churn_prob, COALESCE(r.revenue, 0) AS total_revenue_90d,
           CASE WHEN predicted_churn_prob >= 0.66 THEN 'High' WHEN predicted_churn_prob >= 0.33 THEN 'Medium'
                ELSE 'Low' END AS churn_risk_segment
    FROM (SELECT customer_id, least(1.0, COALESCE(days_since_last_order, 0) / 90.0) AS predicted_churn_prob
          FROM customer_facts)
    LEFT JOIN (SELECT customer_id, sum(line_total) AS revenue FROM good_orders
               WHERE order_ts >= (SELECT as_of FROM clock) - INTERVAL 90 DAY GROUP BY 1) r USING (customer_id)"""
CTES["revenue_served"] = """
    SELECT order_date, net_revenue AS total_revenue, num_orders AS order_count FROM revenue_days"""


def _today() -> str:
    return "(SELECT CAST(as_of AS DATE) FROM clock)"


# --- silver -----------------------------------------------------------------


@query(
    "silver_orders",
    f"""SELECT order_id, customer_id, product_id, CAST(quantity AS BIGINT) AS quantity,
               {rounded("unit_price", 4)} AS unit_price, {rounded("line_total", 4)} AS line_total,
               {moment("order_ts")} AS order_ts FROM good_orders""",
)
def silver_orders(spark, sf):
    return quality.accepted_orders(Lake(spark, sf).checked_orders).withColumns({c: F.round(F.round(c, 6), 4) for c in ("unit_price", "line_total")})


@query(
    "silver_orders_quarantine",
    f"""SELECT order_id, customer_id, product_id, CAST(quantity AS BIGINT) AS quantity,
               {rounded("unit_price", 4)} AS unit_price, order_ts, {moment("order_ts_parsed")} AS order_ts_parsed,
               concat_ws(',', CASE WHEN bad_id THEN 'order_id' END, CASE WHEN bad_customer THEN 'customer' END,
                         CASE WHEN bad_product THEN 'product' END, CASE WHEN bad_price THEN 'price' END,
                         CASE WHEN bad_time THEN 'time' END) AS _failed_rules,
               'validation_failed' AS _quarantine_reason
        FROM checked_orders WHERE bad_id OR bad_customer OR bad_product OR bad_price OR bad_time""",
)
def silver_orders_quarantine(spark, sf):
    return quality.quarantined(Lake(spark, sf).checked_orders).withColumn(
        "unit_price", F.round(F.round("unit_price", 6), 4)
    )


@query(
    "silver_orders_audit",
    """SELECT rule, count(*) AS n_rows FROM (
           SELECT unnest(CASE WHEN bad_id OR bad_customer OR bad_product OR bad_price OR bad_time
                  THEN list_filter([CASE WHEN bad_id THEN 'order_id' END, CASE WHEN bad_customer THEN 'customer' END,
                        CASE WHEN bad_product THEN 'product' END, CASE WHEN bad_price THEN 'price' END,
                        CASE WHEN bad_time THEN 'time' END], lambda x: x IS NOT NULL)
                  ELSE ['ok'] END) AS rule FROM checked_orders) GROUP BY rule""",
)
def silver_orders_audit(spark, sf):
    return quality.audit(Lake(spark, sf).checked_orders)


@query(
    "silver_returns",
    f"""SELECT return_id, order_id, customer_id, product_id, {day("return_date")} AS return_date, reason_code,
               refund_amount FROM good_returns""",
)
def silver_returns(spark, sf):
    return Lake(spark, sf).returns


@query(
    "silver_returns_quarantine",
    f"""SELECT return_id, order_id, customer_id, product_id, return_date, reason_code, refund_amount,
               {day("return_date_parsed")} AS return_date_parsed,
               concat_ws(',', CASE WHEN bad_id THEN 'return_id' END, CASE WHEN bad_order THEN 'order' END,
                         CASE WHEN bad_refund THEN 'refund' END) AS _failed_rules,
               'validation_failed' AS _quarantine_reason
        FROM checked_returns WHERE bad_id OR bad_order OR bad_refund""",
)
def silver_returns_quarantine(spark, sf):
    return quality.quarantined(Lake(spark, sf).checked_returns)


@query(
    "orders_without_repeats",
    """SELECT l_orderkey || '-' || l_linenumber AS order_id, CAST(l_partkey AS BIGINT) AS product,
              CAST(l_suppkey AS BIGINT) AS supplier, l_extendedprice AS amount
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                 ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def orders_without_repeats(spark, sf):
    rows = testdata.table(spark, sf, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("l_partkey").alias("product"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("amount"),
        "l_shipdate",
    )
    return quality.first_per_key(rows, ["order_id"], ["l_shipdate", "product", "supplier", "amount"]).drop("l_shipdate")


@query(
    "latest_order_line",
    """SELECT customer_id, order_id, product_id FROM (
         SELECT *, row_number() OVER (PARTITION BY customer_id
                ORDER BY order_ts DESC, order_id DESC, product_id DESC) AS rn
         FROM good_orders) WHERE rn = 1""",
)
def latest_order_line(spark, sf):
    rows = Lake(spark, sf).orders.select("customer_id", "order_id", "product_id", "order_ts")
    return quality.latest_per_key(rows, ["customer_id"], ["order_ts", "order_id", "product_id"]).drop("order_ts")


@query(
    "standard_categories",
    """SELECT CASE WHEN tidy = 'promo' THEN 'promotion' ELSE tidy END AS category, count(*) AS n
       FROM (SELECT regexp_replace(lower(trim('  ' || p_type || ' ' || p_name || ' ')), '[\\s_]+', '_', 'g') AS full_tidy,
                    lower(trim(p_type)) AS tidy FROM part) GROUP BY 1""",
)
def standard_categories(spark, sf):
    padded = testdata.table(spark, sf, "part").select(
        F.concat(F.lit("  "), F.initcap("p_type"), F.lit(" ")).alias("raw")
    )
    named = padded.select(quality.standard_category("raw", {"promo": "promotion"}).alias("category"))
    return named.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "masked_customers",
    """SELECT customer_id, sha256(first_name) AS first_name, last_name, sha256(email) AS email, phone, city, country,
              region, segment FROM customers WHERE segment IN ('BUILDING', 'MACHINERY')""",
)
def masked_customers(spark, sf):
    people = testdata.customers(spark, sf)
    grants = people.select(F.col("segment").alias("team")).distinct().select(
        F.when(F.col("team").isin("BUILDING", "MACHINERY"), "ann").otherwise("bob").alias("user"), "team"
    )
    return quality.masked_view(people, ["first_name", "email"], "segment", grants, "ann").select(*people.columns)


@query(
    "orders_volume_report",
    """SELECT 'orders_raw' AS table_name, n AS n_rows, column_name, n - filled AS n_null,
              round((n - filled) * 1.0 / n, 4) AS null_rate
       FROM (SELECT count(*) AS n, count(order_id) AS order_id, count(customer_id) AS customer_id,
                    count(product_id) AS product_id, count(quantity) AS quantity, count(unit_price) AS unit_price,
                    count(order_ts) AS order_ts FROM orders_raw)
       UNPIVOT (filled FOR column_name IN (order_id, customer_id, product_id, quantity, unit_price, order_ts))""",
)
def orders_volume_report(spark, sf):
    return quality.volume_report(testdata.orders_raw(spark, sf), "orders_raw")


@query(
    "repeated_order_keys",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def repeated_order_keys(spark, sf):
    return quality.repeated_keys(testdata.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "gold_silver_reconciliation",
    """SELECT a AS left_total, b AS right_total, round(a - b, 2) AS difference, abs(a - b) <= 0.01 AS matches
       FROM (SELECT round((SELECT sum(gross_revenue) FROM revenue_days), 2) AS a,
                    round((SELECT sum(line_total) FROM good_orders), 2) AS b)""",
)
def gold_silver_reconciliation(spark, sf):
    lake = Lake(spark, sf)
    return quality.reconcile(lake.revenue, "gross_revenue", lake.orders, "line_total")


@query(
    "order_freshness",
    f"""SELECT 'orders' AS table_name, {moment("newest")} AS newest,
               date_diff('minute', newest, as_of + INTERVAL 1 DAY) AS lag_minutes,
               date_diff('minute', newest, as_of + INTERVAL 1 DAY) > 720 AS stale
        FROM (SELECT max(order_ts) AS newest FROM good_orders), clock""",
)
def order_freshness(spark, sf):
    lake = Lake(spark, sf)
    return quality.freshness(lake.orders, "orders", "order_ts", lake.as_of + timedelta(days=1), 720)


@query(
    "feature_lookup",
    """SELECT COALESCE(c.customer_id IS NOT NULL, FALSE) AS valid, count(*) AS n_rows,
              CAST(COALESCE(sum(c.total_orders), 0) AS BIGINT) AS orders_seen
       FROM orders_raw o LEFT JOIN customer_facts c ON o.customer_id = c.customer_id GROUP BY 1""",
)
def feature_lookup(spark, sf):
    lake = Lake(spark, sf)
    entities = testdata.orders_raw(spark, sf).select("order_id", "customer_id")
    found = quality.feature_lookup(entities, lake.customer_metrics.select("customer_id", "total_orders"), "customer_id")
    return found.groupBy(F.col("_valid").alias("valid")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("total_orders"), F.lit(0)).alias("orders_seen")
    )


# --- gold -------------------------------------------------------------------


def _amounts(df: DataFrame, *names: str) -> DataFrame:
    """Sums of cents: two places are exact."""
    return df.withColumns({n: F.round(F.round(n, 6), 2) for n in names})


@query(
    "gold_revenue_daily",
    f"""SELECT {day("order_date")} AS order_date, num_orders, {rounded("gross_revenue")} AS gross_revenue,
               {rounded("total_refunds")} AS total_refunds, net_revenue FROM revenue_days""",
)
def gold_revenue_daily(spark, sf):
    return _amounts(Lake(spark, sf).revenue, "gross_revenue", "total_refunds")


@query(
    "gold_revenue_daily_full",
    f"""SELECT {day("COALESCE(s.order_date, r.order_date)")} AS order_date, COALESCE(num_orders, 0) AS num_orders,
               {rounded("gross_revenue")} AS gross_revenue,
               {rounded("COALESCE(total_refunds, 0)")} AS total_refunds,
               {rounded("COALESCE(gross_revenue, 0) - COALESCE(total_refunds, 0)")} AS net_revenue
        FROM sold_days s FULL JOIN refund_days r ON s.order_date = r.order_date""",
)
def gold_revenue_daily_full(spark, sf):
    lake = Lake(spark, sf)
    return _amounts(gold.revenue_daily(lake.orders, lake.returns, how="full"), "gross_revenue", "total_refunds")


@query(
    "gold_customer_metrics",
    f"""SELECT customer_id, first_name, last_name, city, country, total_orders, {rounded("total_spend")} AS total_spend,
               avg_order_value, {moment("last_order_ts")} AS last_order_ts, days_since_last_order, total_returns,
               {rounded("total_refunded")} AS total_refunded FROM customer_facts""",
)
def gold_customer_metrics(spark, sf):
    return _amounts(Lake(spark, sf).customer_metrics, "total_spend", "total_refunded")


@query(
    "gold_product_performance",
    f"""SELECT product_id, product_name, category, unit_price, total_units_sold,
               {rounded("total_revenue")} AS total_revenue,
               {rounded("avg_quantity_per_order", 4)} AS avg_quantity_per_order, total_returns, return_rate_pct
        FROM product_facts""",
)
def gold_product_performance(spark, sf):
    rows = _amounts(Lake(spark, sf).product_performance, "total_revenue")
    return rows.withColumn("avg_quantity_per_order", F.round(F.round("avg_quantity_per_order", 6), 4))


def _regional(lake: Lake) -> DataFrame:
    regions = lake.customers.select("customer_id", "region")
    placed = spread_join(lake.orders, regions, "customer_id", "inner", size=lake.customer_bytes)
    return spread_join(placed, lake.products.select("product_id", "category"), "product_id", "inner")


CTES["regional_orders"] = """
    SELECT o.*, c.region, p.category FROM good_orders o JOIN customers c ON o.customer_id = c.customer_id
    JOIN products p ON o.product_id = p.product_id"""


@query(
    "revenue_by_region_category",
    f"""SELECT {day("order_ts")} AS order_date, region, category, count(order_id) AS num_orders,
               {rounded("sum(line_total)")} AS revenue FROM regional_orders GROUP BY 1, 2, 3""",
)
def revenue_by_region_category(spark, sf):
    return gold.revenue_by(_regional(Lake(spark, sf)), "region", "category")


@query(
    "revenue_rollup",
    f"""SELECT region, category, count(order_id) AS num_orders, {rounded("sum(line_total)")} AS revenue
        FROM regional_orders GROUP BY ROLLUP (region, category)""",
)
def revenue_rollup(spark, sf):
    return gold.revenue_rollup(_regional(Lake(spark, sf)), "region", "category")


@query(
    "revenue_month_over_month",
    f"""SELECT m.category, {day("m.month")} AS "month", {rounded("m.total")} AS revenue,
               {rounded("p.total")} AS previous_revenue,
               {rounded("(m.total - p.total) * 100 / p.total", 1)} AS change_pct, m.total < p.total AS declined
        FROM (SELECT category, date_trunc('month', order_ts) AS month, sum(line_total) AS total
              FROM regional_orders GROUP BY 1, 2) m
        LEFT JOIN (SELECT category, date_trunc('month', order_ts) AS month, sum(line_total) AS total
              FROM regional_orders GROUP BY 1, 2) p
          ON m.category = p.category AND m.month = p.month + INTERVAL 1 MONTH""",
)
def revenue_month_over_month(spark, sf):
    return gold.month_over_month(_regional(Lake(spark, sf)), "category")


@query(
    "customer_rfm",
    f"""SELECT customer_id, days_since_last_order, total_orders, {rounded("total_spend")} AS total_spend,
               r_score, f_score, m_score, r_score || '' || f_score || '' || m_score AS rfm_code
        FROM (SELECT *, ntile(5) OVER (ORDER BY days_since_last_order DESC, customer_id) AS r_score,
                     ntile(5) OVER (ORDER BY total_orders, customer_id) AS f_score,
                     ntile(5) OVER (ORDER BY {rounded("total_spend")}, customer_id) AS m_score
              FROM customer_facts WHERE total_orders > 0)""",
)
def customer_rfm(spark, sf):
    return gold.customer_rfm(_amounts(Lake(spark, sf).customer_metrics, "total_spend"))


@query(
    "customer_features",
    f"""SELECT customer_id, date_diff('day', CAST(max(order_ts) AS DATE), {_today()}) AS days_since_order,
               count(CASE WHEN order_ts >= (SELECT as_of FROM clock) - INTERVAL 30 DAY THEN 1 END)
                   AS order_frequency_30d,
               {rounded("avg(line_total)")} AS avg_order_value,
               {rounded('''sum(line_total) / greatest(date_diff('day', CAST(min(order_ts) AS DATE),
                   CAST(max(order_ts) AS DATE)) / 365.0, 1.0)''')} AS clv_estimate
        FROM good_orders GROUP BY customer_id""",
)
def customer_features(spark, sf):
    lake = Lake(spark, sf)
    return gold.customer_features(lake.orders, lake.as_of)


@query(
    "product_features",
    f"""SELECT *, rank() OVER (PARTITION BY category ORDER BY gmv_30d DESC) AS category_rank FROM (
          SELECT p.product_id, p.category, COALESCE({rounded("s.now_sum")}, 0) AS gmv_30d,
                 CAST(COALESCE(s.units, 0) AS BIGINT) AS units_sold_30d,
                 {rounded("COALESCE(s.now_sum, 0) / s.earlier_sum", 4)} AS trend_score
          FROM products p LEFT JOIN (
            SELECT product_id, sum(CASE WHEN recent THEN line_total END) AS now_sum,
                   sum(CASE WHEN recent THEN quantity END) AS units,
                   sum(CASE WHEN NOT recent THEN line_total END) AS earlier_sum
            FROM (SELECT *, order_ts >= (SELECT as_of FROM clock) - INTERVAL 30 DAY AS recent FROM good_orders
                  WHERE order_ts >= (SELECT as_of FROM clock) - INTERVAL 60 DAY) GROUP BY 1) s USING (product_id))""",
)
def product_features(spark, sf):
    lake = Lake(spark, sf)
    return gold.product_features(lake.orders, lake.products, lake.as_of)


@query(
    "customer_risk_segments",
    f"""SELECT customer_id, {rounded("predicted_churn_prob", 4)} AS predicted_churn_prob, churn_risk_segment,
               {rounded("total_revenue_90d")} AS total_revenue_90d FROM scored_customers""",
)
def customer_risk_segments(spark, sf):
    rows = _amounts(Lake(spark, sf).scored_customers, "total_revenue_90d")
    return rows.withColumn("predicted_churn_prob", F.round(F.round("predicted_churn_prob", 6), 4))


# --- metrics ----------------------------------------------------------------


def _register_metric(name: str, metric: str, period: str, sql: str, limit: int = 10, bounded: bool = False):
    @query(name, sql)
    def run(spark, sf):
        lake = Lake(spark, sf)
        return metrics.metric(lake.serving, metric, period, limit, lake.as_of, bounded)


_START = {
    "today": _today(),
    "yesterday": f"{_today()} - INTERVAL 1 DAY",
    "last 7 days": f"{_today()} - INTERVAL 7 DAY",
    "last 14 days": f"{_today()} - INTERVAL 14 DAY",
    "last 30 days": f"{_today()} - INTERVAL 30 DAY",
    "this month": f"date_trunc('month', {_today()})",
    "last month": f"date_trunc('month', {_today()} - INTERVAL 1 MONTH)",
}

for _name, _period in {"last_30_days": "last 30 days", "yesterday": "yesterday", "last_month": "last month"}.items():
    _register_metric(
        f"metric_revenue_{_name}",
        "revenue",
        f"  {_period.title()} ",
        f"""SELECT {day("order_date")} AS day, {rounded("sum(total_revenue)")} AS total_revenue_eur,
                   count(*) AS order_count, CAST(sum(order_count) AS BIGINT) AS orders_total
            FROM revenue_served WHERE order_date >= {_START[_period]} GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
    )
_register_metric(
    "metric_revenue_last_month_closed",
    "revenue",
    "last month",
    f"""SELECT {day("order_date")} AS day, {rounded("sum(total_revenue)")} AS total_revenue_eur,
               count(*) AS order_count, CAST(sum(order_count) AS BIGINT) AS orders_total
        FROM revenue_served WHERE order_date >= {_START["last month"]} AND order_date < {_START["this month"]}
        GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
    bounded=True,
)
_register_metric(
    "metric_orders_last_7_days",
    "orders",
    "no such period",
    f"""SELECT {day("order_ts")} AS day, count(*) AS order_count, count(DISTINCT customer_id) AS unique_customers
        FROM good_orders WHERE order_ts >= {_START["last 7 days"]} GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
)
_register_metric(
    "metric_orders_this_month",
    "orders",
    "this month",
    f"""SELECT {day("order_ts")} AS day, count(*) AS order_count, count(DISTINCT customer_id) AS unique_customers
        FROM good_orders WHERE order_ts >= {_START["this month"]} GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
)
_register_metric(
    "metric_customers",
    "customers",
    "today",
    f"""SELECT churn_risk_segment, count(*) AS customer_count,
               {rounded("avg(predicted_churn_prob)", 3)} AS avg_churn_prob,
               {rounded("avg(total_revenue_90d)")} AS avg_revenue_90d
        FROM scored_customers GROUP BY 1 ORDER BY avg_churn_prob DESC, 1 LIMIT 10""",
)
_register_metric(
    "metric_products_last_30_days",
    "products",
    "last 30 days",
    f"""SELECT product_name, {rounded("sum(total_revenue)")} AS total_revenue_eur,
               CAST(sum(units_sold) AS BIGINT) AS units_sold, {rounded("avg(return_rate)", 3)} AS avg_return_rate
        FROM product_days WHERE snapshot_date >= {_START["last 30 days"]} GROUP BY 1
        ORDER BY total_revenue_eur DESC, product_name LIMIT 10""",
)
_register_metric(
    "metric_returns_last_14_days",
    "returns",
    "last 14 days",
    f"""SELECT {day("return_date")} AS day, count(*) AS return_count,
               {rounded("sum(refund_amount)")} AS refund_total_eur
        FROM good_returns WHERE return_date >= {_START["last 14 days"]} GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
)


@query(
    "segments_by_size",
    f"""SELECT churn_risk_segment, count(*) AS customer_count,
               {rounded("avg(predicted_churn_prob)", 3)} AS avg_churn_prob
        FROM scored_customers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def segments_by_size(spark, sf):
    return metrics.segments_by_size(Lake(spark, sf).scored_customers)


@query(
    "segment_listing",
    f"""SELECT churn_risk_segment, count(*) AS customer_count,
               {rounded("avg(predicted_churn_prob)", 3)} AS avg_churn_prob
        FROM scored_customers GROUP BY 1 ORDER BY avg_churn_prob DESC, 1 LIMIT 10""",
)
def segment_listing(spark, sf):
    grouped = Lake(spark, sf).scored_customers.groupBy("churn_risk_segment").agg(
        F.count(F.lit(1)).alias("customer_count"), F.avg("predicted_churn_prob").alias("predicted_churn_prob")
    )
    return metrics.segment_listing(grouped)


@query(
    "recent_revenue",
    f"""SELECT {day("order_date")} AS day, {rounded("total_revenue")} AS revenue_eur, order_count
        FROM revenue_served WHERE order_date >= {_START["last 30 days"]} ORDER BY 1 DESC LIMIT 14""",
)
def recent_revenue(spark, sf):
    lake = Lake(spark, sf)
    return metrics.recent_revenue(lake.serving["revenue_daily"], "last 30 days", lake.as_of)


CTES["best_products"] = f"""
    SELECT product_name, CAST(sum(units_sold) AS BIGINT) AS total_units, {rounded("sum(total_revenue)")} AS revenue_eur
    FROM product_days WHERE snapshot_date >= {_START["last 30 days"]} GROUP BY 1
    ORDER BY revenue_eur DESC, product_name"""


@query("top_products", "SELECT * FROM best_products ORDER BY revenue_eur DESC, product_name LIMIT 10")
def top_products(spark, sf):
    lake = Lake(spark, sf)
    return metrics.top_products(lake.product_days, "last 30 days", lake.as_of)


@query(
    "most_returned_products",
    """SELECT product_id, product_name, category, return_rate_pct FROM product_facts
       ORDER BY return_rate_pct DESC, product_id LIMIT 10""",
)
def most_returned_products(spark, sf):
    return metrics.most_returned(Lake(spark, sf).product_performance)


_CHART_SQL = {
    "revenue": ("order_date", "sum(total_revenue)", "revenue_served", "order_date"),
    "orders": ("CAST(order_ts AS DATE)", "count(*)", "good_orders", "order_ts"),
    "returns": ("return_date", "count(*)", "good_returns", "return_date"),
    "return_rate": ("snapshot_date", "avg(return_rate) * 100", "product_days", "snapshot_date"),
}
for _name, (_x, _y, _table, _when) in _CHART_SQL.items():

    @query(
        f"chart_{_name}",
        f"""SELECT {day(_x)} AS x, COALESCE({rounded(_y)}, 0) AS y FROM {_table}
            WHERE {_when} >= {_START["last 30 days"]} GROUP BY 1""",
    )
    def _chart(spark, sf, name=_name):
        lake = Lake(spark, sf)
        return metrics.chart_series(lake.serving, name, "last 30 days", lake.as_of)


@query(
    "chart_spec_revenue",
    f"""SELECT '{{"$schema":"https://vega.github.io/schema/vega-lite/v5.json","title":"Revenue (EUR) — last 7 days",'
          || '"mark":"line","data":{{"values":[' || string_agg('{{"x":"' || x || '","y":' || CAST(y AS DECIMAL(38,2)) || '}}', ',' ORDER BY x)
          || ']}},"encoding":{{"x":{{"field":"x","type":"ordinal","title":"Date"}},'
          || '"y":{{"field":"y","type":"quantitative","title":"Revenue (EUR)"}}}},"width":600,"height":300}}' AS spec
        FROM (SELECT {day("order_date")} AS x, {rounded("sum(total_revenue)")} AS y FROM revenue_served
              WHERE order_date >= {_START["last 7 days"]} GROUP BY 1)""",
)
def chart_spec_revenue(spark, sf):
    lake = Lake(spark, sf)
    series = metrics.chart_series(lake.serving, "revenue", "last 7 days", lake.as_of)
    return metrics.chart_spec(series, "revenue", "line", "last 7 days")


CTES["kpis"] = f"""
    SELECT 'revenue' AS metric, {rounded("sum(total_revenue)")} AS value FROM revenue_served
    WHERE order_date = {_today()} - INTERVAL 1 DAY
    UNION ALL SELECT 'orders', CAST(count(*) AS DOUBLE) FROM good_orders
    WHERE CAST(order_ts AS DATE) = {_today()} - INTERVAL 1 DAY
    UNION ALL SELECT 'return_rate', {rounded("avg(return_rate) * 100")} FROM product_days
    WHERE snapshot_date = {_today()} - INTERVAL 1 DAY"""
CTES["kpi_rules"] = """
    SELECT * FROM (VALUES ('low revenue', 'revenue', 'below', 500000.0), ('busy day', 'orders', 'above', 5.0),
                          ('high returns', 'return_rate', 'above', 15.0)) v(name, metric, condition, threshold)"""
CTES["kpi_alerts"] = """
    SELECT name, metric, condition, threshold, value,
           COALESCE(CASE condition WHEN 'below' THEN value < threshold ELSE value > threshold END, FALSE) AS fired
    FROM kpi_rules LEFT JOIN kpis USING (metric)"""


def _rules(spark) -> DataFrame:
    return spark.createDataFrame(
        [
            ("low revenue", "revenue", "below", 500000.0),
            ("busy day", "orders", "above", 5.0),
            ("high returns", "return_rate", "above", 15.0),
        ],
        "name STRING, metric STRING, condition STRING, threshold DOUBLE",
    )


@query("kpi_values", "SELECT * FROM kpis")
def kpi_values(spark, sf):
    lake = Lake(spark, sf)
    return metrics.kpi_values(lake.serving, lake.as_of)


@query("kpi_alerts", "SELECT * FROM kpi_alerts")
def kpi_alerts(spark, sf):
    lake = Lake(spark, sf)
    return metrics.fired_alerts(metrics.kpi_values(lake.serving, lake.as_of), _rules(spark))


@query(
    "frequent_customers",
    """SELECT customer_id, count(*) AS order_count FROM good_orders
       WHERE order_ts >= (SELECT as_of FROM clock) - INTERVAL 30 DAY GROUP BY 1 HAVING count(*) > 3""",
)
def frequent_customers(spark, sf):
    lake = Lake(spark, sf)
    return metrics.frequent_customers(lake.orders, 3, 30, lake.as_of)


@query(
    "frequent_customers_at_risk",
    f"""SELECT customer_id, total_orders, {rounded("predicted_churn_prob", 4)} AS predicted_churn_prob
        FROM customer_facts JOIN scored_customers USING (customer_id)
        WHERE total_orders > 5 AND churn_risk_segment = 'High'""",
)
def frequent_customers_at_risk(spark, sf):
    lake = Lake(spark, sf)
    rows = metrics.frequent_at_risk(lake.customer_metrics, lake.scored_customers)
    return rows.withColumn("predicted_churn_prob", F.round(F.round("predicted_churn_prob", 6), 4))


@query(
    "products_returned_too_often",
    f"""SELECT product_id, n AS order_lines, COALESCE(r, 0) AS returned,
               {rounded("COALESCE(r, 0) * 1.0 / n", 4)} AS return_rate
        FROM (SELECT product_id, count(*) AS n FROM good_orders
              WHERE order_ts >= {_today()} - INTERVAL 90 DAY AND order_ts < {_today()} GROUP BY 1)
        LEFT JOIN (SELECT product_id, count(*) AS r FROM good_returns
              WHERE return_date >= {_today()} - INTERVAL 90 DAY AND return_date < {_today()} GROUP BY 1)
        USING (product_id) WHERE COALESCE(r, 0) * 1.0 / n > 0.2""",
)
def products_returned_too_often(spark, sf):
    lake = Lake(spark, sf)
    end = lake.as_of.date()
    return metrics.returned_too_often(lake.orders, lake.returns, 0.2, end - timedelta(days=90), end)


@query(
    "large_orders_by_country",
    f"""SELECT country, count(*) AS order_count, {rounded("sum(line_total)")} AS revenue
        FROM good_orders JOIN customers USING (customer_id)
        WHERE line_total > 200 AND order_ts >= (SELECT as_of FROM clock) - INTERVAL 30 DAY GROUP BY 1""",
)
def large_orders_by_country(spark, sf):
    lake = Lake(spark, sf)
    return metrics.large_orders_by_country(lake.orders, lake.customers, 200.0, 30, lake.as_of)


SUMMARY_SQL = f"""SELECT 'revenue' AS section, 'total_revenue' AS key, {rounded("sum(total_revenue)")} AS value
        FROM revenue_served WHERE order_date >= {_START["last 30 days"]}
        UNION ALL SELECT 'revenue', 'orders', CAST(sum(order_count) AS DOUBLE)
        FROM revenue_served WHERE order_date >= {_START["last 30 days"]}
        UNION ALL SELECT 'revenue', 'average_order_value', {rounded("sum(total_revenue) / sum(order_count)")}
        FROM revenue_served WHERE order_date >= {_START["last 30 days"]}
        UNION ALL SELECT 'top_products', product_name, revenue_eur
        FROM (SELECT * FROM best_products ORDER BY revenue_eur DESC, product_name LIMIT 5)
        UNION ALL SELECT 'alerts', name, value FROM kpi_alerts WHERE fired"""


def summary(lake: Lake, forecast: DataFrame | None = None) -> DataFrame:
    alerts = metrics.fired_alerts(metrics.kpi_values(lake.serving, lake.as_of), _rules(lake.spark))
    return metrics.business_summary(
        lake.serving["revenue_daily"], lake.product_days, alerts, forecast, "last 30 days", lake.as_of
    )


@query("business_summary", SUMMARY_SQL)
def business_summary(spark, sf):
    return summary(Lake(spark, sf))
