"""Commerce tables derived from the TPC-H-like parquet tables.

The source tables hold no bad rows, so bad keys, prices and time stamps are
written into the derived columns; every source row is kept. Each function has
its SQL twin in SQL, used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType



_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table; its schema is read from the file once per process."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def latest(df: DataFrame, column: str):
    """Newest value of a column, used as the "as of" moment of a job."""
    return df.agg(F.max(column)).first()[0]


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _line_id(*columns: str) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in columns])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = F.col("o_orderdate") + F.make_dt_interval(hours=F.col("l_linenumber"))
    key = "l_orderkey"
    return _joined_lines(spark, sf_dir).select(
        F.when(~_every(key, 101), _line_id(key, "l_linenumber", "l_partkey")).alias("order_id"),
        F.when(_every(key, 97), F.lit(None).cast("string"))
        .when(_every(key, 73), F.concat(F.lit("X"), F.col("o_custkey")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        F.when(_every(key, 79), F.concat(F.lit("X"), F.col("l_partkey")))
        .otherwise(F.col("l_partkey").cast("string"))
        .alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(_every(key, 89), F.lit(0.0))
        .when(_every(key, 103), F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
        .alias("unit_price"),
        F.when(_every(key, 83), F.lit("not-a-time"))
        .otherwise(F.date_format(placed, "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("order_ts"),
    )


def returns_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "l_orderkey"
    return (
        _joined_lines(spark, sf_dir)
        .where(F.col("l_returnflag") == "R")
        .select(
            F.when(~_every(key, 113), F.concat(F.lit("R"), _line_id(key, "l_linenumber", "l_partkey"))).alias(
                "return_id"
            ),
            F.when(_every(key, 109), F.lit("X"))
            .otherwise(_line_id(key, "l_linenumber", "l_partkey"))
            .alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.when(_every(key, 127), F.lit("someday"))
            .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
            .alias("return_date"),
            F.col("l_linestatus").alias("reason_code"),
            F.when(_every(key, 107), -F.col("l_extendedprice"))
            .otherwise(F.col("l_extendedprice"))
            .alias("refund_amount"),
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    number = F.col("c_custkey").cast("string")
    return people.select(
        number.alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lit("c"), number, F.lit("@example.com")).alias("email"),
        F.when(~_every("c_custkey", 5), F.concat(F.lit("+31"), number)).alias("phone"),
        F.concat(F.lit("City "), (F.col("c_custkey") % 40).cast("string")).alias("city"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("segment"),
    )


def customers_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next day's customer extract: some e-mails and cities changed, some phones moved, some rows gone."""
    number = F.col("customer_id").cast("bigint")
    base = customers(spark, sf_dir)
    return base.where(number % 11 != 0).select(
        *[c for c in base.columns if c not in ("email", "city", "segment")],
        F.when(number % 7 == 0, F.concat(F.lit("new"), F.col("email"))).otherwise(F.col("email")).alias("email"),
        F.when(number % 9 == 0, F.lit("Moved")).otherwise(F.col("city")).alias("city"),
        F.when(number % 4 == 0, F.lit("UPGRADED")).otherwise(F.col("segment")).alias("segment"),
    ).select(*base.columns)


def customers_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first extract: some customers had not signed up yet."""
    return customers(spark, sf_dir).where(F.col("customer_id").cast("bigint") % 13 != 0)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("p_brand").alias("supplier_id"),
    )


def products_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next product extract: changed prices, discontinued products missing."""
    number = F.col("product_id").cast("bigint")
    return (
        products(spark, sf_dir)
        .where(number % 11 != 0)
        .withColumn("unit_price", F.when(number % 5 == 0, F.col("unit_price") + 1).otherwise(F.col("unit_price")))
    )


def products_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).where(F.col("product_id").cast("bigint") % 13 != 0)


def model_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("value").alias("latency_ms"),
        F.when(F.col("event_type") == "error", F.lit("error")).alias("error"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("model_version"),
        F.col("event_id").alias("request_id"),
        F.from_json("props", "map<string,string>").alias("features"),
    )


def chat_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("request_timestamp"),
        F.col("event_id").alias("request_id"),
        F.col("event_type").alias("request"),
        F.concat_ws(" ", "event_type", "props", F.col("user_id").cast("string")).alias("response"),
        F.when(F.col("event_type") == "error", 500)
        .when((F.col("event_type") == "click") & (F.col("user_id") % 10 == 0), 404)
        .otherwise(200)
        .alias("status_code"),
    )


# SQL twins for the oracle: name -> body of a common table expression.
SQL = {
    "orders_raw": """
        SELECT CASE WHEN l_orderkey % 101 <> 0
                    THEN l_orderkey || '-' || l_linenumber || '-' || l_partkey END AS order_id,
               CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 73 = 0 THEN 'X' || o_custkey
                    ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN l_orderkey % 79 = 0 THEN 'X' || l_partkey
                    ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CASE WHEN l_orderkey % 89 = 0 THEN 0.0 WHEN l_orderkey % 103 = 0 THEN NULL
                    ELSE l_extendedprice / l_quantity END AS unit_price,
               CASE WHEN l_orderkey % 83 = 0 THEN 'not-a-time'
                    ELSE strftime(o_orderdate + to_hours(l_linenumber), '%Y-%m-%dT%H:%M:%S') END AS order_ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "returns_raw": """
        SELECT CASE WHEN l_orderkey % 113 <> 0
                    THEN 'R' || l_orderkey || '-' || l_linenumber || '-' || l_partkey END AS return_id,
               CASE WHEN l_orderkey % 109 = 0 THEN 'X'
                    ELSE l_orderkey || '-' || l_linenumber || '-' || l_partkey END AS order_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CASE WHEN l_orderkey % 127 = 0 THEN 'someday'
                    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS return_date,
               l_linestatus AS reason_code,
               CASE WHEN l_orderkey % 107 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS refund_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R'""",
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               'c' || c_custkey || '@example.com' AS email,
               CASE WHEN c_custkey % 5 <> 0 THEN '+31' || c_custkey END AS phone,
               'City ' || (c_custkey % 40) AS city, n_name AS country, r_name AS region,
               c_mktsegment AS segment
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "customers_first": "SELECT * FROM customers WHERE CAST(customer_id AS BIGINT) % 13 <> 0",
    "customers_next": """
        SELECT customer_id, first_name, last_name,
               CASE WHEN CAST(customer_id AS BIGINT) % 7 = 0 THEN 'new' || email ELSE email END AS email,
               phone,
               CASE WHEN CAST(customer_id AS BIGINT) % 9 = 0 THEN 'Moved' ELSE city END AS city,
               country, region,
               CASE WHEN CAST(customer_id AS BIGINT) % 4 = 0 THEN 'UPGRADED' ELSE segment END AS segment
        FROM customers WHERE CAST(customer_id AS BIGINT) % 11 <> 0""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
               p_retailprice AS unit_price, p_brand AS supplier_id FROM part""",
    "products_first": "SELECT * FROM products WHERE CAST(product_id AS BIGINT) % 13 <> 0",
    "products_next": """
        SELECT product_id, product_name, category,
               CASE WHEN CAST(product_id AS BIGINT) % 5 = 0 THEN unit_price + 1 ELSE unit_price END AS unit_price,
               supplier_id
        FROM products WHERE CAST(product_id AS BIGINT) % 11 <> 0""",
    "model_log": """
        SELECT ts AS "timestamp", value AS latency_ms,
               CASE WHEN event_type = 'error' THEN 'error' END AS error,
               'v' || (user_id % 3) AS model_version, event_id AS request_id,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS feature_k
        FROM events""",
    "chat_log": """
        SELECT ts AS request_timestamp, event_id AS request_id, event_type AS request,
               event_type || ' ' || props || ' ' || user_id AS response,
               CASE WHEN event_type = 'error' THEN 500
                    WHEN event_type = 'click' AND user_id % 10 = 0 THEN 404 ELSE 200 END AS status_code
        FROM events""",
}
