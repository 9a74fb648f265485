"""Dimension maintenance, snapshots, change feeds and file round trips."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from merchlake.functions.ordering import neighbours
from merchlake.functions.scalars import OPEN_END
from merchlake.operators import dims, quality
from merchlake.plans.commerce import Lake, _today
from merchlake.plans.registry import CTES, day, moment, query, rounded
from merchlake.session import scratch_path
from merchlake.sources import files, hashtree, periods, schemas, snapshots, testdata

DAY_1 = datetime(1998, 1, 1)
DAY_2 = datetime(1998, 7, 1)
OPEN = "9999-12-31 00:00:00.000000"

_ATTRIBUTES = "first_name, last_name, email, city, country, phone"

CTES["dim_state"] = f"""
    SELECT t.customer_id, t.first_name, t.last_name, t.email, t.city, t.country, t.phone,
           (s.customer_id IS NULL OR same) AS is_current, TIMESTAMP '1998-01-01' AS valid_from,
           CASE WHEN s.customer_id IS NULL OR same THEN TIMESTAMP '9999-12-31' ELSE TIMESTAMP '1998-07-01' END
               AS valid_to
    FROM customers_first t LEFT JOIN (SELECT n.*, f.customer_id IS NOT NULL AND n.email IS NOT DISTINCT FROM f.email
             AND n.city IS NOT DISTINCT FROM f.city AND n.country IS NOT DISTINCT FROM f.country
             AND n.phone IS NOT DISTINCT FROM f.phone AS same
          FROM customers_next n LEFT JOIN customers_first f ON n.customer_id = f.customer_id) s
      ON t.customer_id = s.customer_id
    UNION ALL
    SELECT n.customer_id, n.first_name, n.last_name, n.email, n.city, n.country, n.phone, TRUE,
           TIMESTAMP '1998-07-01', TIMESTAMP '9999-12-31'
    FROM customers_next n LEFT JOIN customers_first f ON n.customer_id = f.customer_id
    WHERE f.customer_id IS NULL OR n.email IS DISTINCT FROM f.email OR n.city IS DISTINCT FROM f.city
       OR n.country IS DISTINCT FROM f.country OR n.phone IS DISTINCT FROM f.phone"""


def _first(spark, sf):
    return dims.scd2_start(testdata.customers_first(spark, sf), DAY_1)


def _second(spark, sf):
    return dims.scd2_apply(_first(spark, sf), testdata.customers_next(spark, sf), DAY_2)


@query(
    "scd2_first_load",
    f"""SELECT customer_id, {_ATTRIBUTES}, sha256(concat_ws('|', email, city, country, phone)) AS row_hash,
               TRUE AS is_current, '1998-01-01 00:00:00.000000' AS valid_from, '{OPEN}' AS valid_to
        FROM customers_first""",
)
def scd2_first_load(spark, sf):
    return dims.scd2_start(testdata.customers_first(spark, sf), DAY_1, null_token=None)


@query(
    "scd2_after_second_load",
    f"""SELECT customer_id, {_ATTRIBUTES}, is_current, {moment("valid_from")} AS valid_from,
               {moment("valid_to")} AS valid_to FROM dim_state""",
)
def scd2_after_second_load(spark, sf):
    return _second(spark, sf).drop("row_hash")


@query("scd2_repeated_load_changes_nothing", "SELECT count(*) AS n, count(DISTINCT customer_id) AS keys FROM dim_state")
def scd2_repeated_load(spark, sf):
    again = dims.scd2_apply(_second(spark, sf), testdata.customers_next(spark, sf), DAY_2 + timedelta(days=1))
    return again.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("customer_id").alias("keys"))


@query("scd2_integrity", "SELECT customer_id, 0 AS open_versions, 0 AS overlaps FROM dim_state WHERE FALSE")
def scd2_integrity(spark, sf):
    return dims.scd2_problems(_second(spark, sf), "customer_id")


CTES["faulty_versions"] = """
    SELECT customer_id, is_current AND CAST(customer_id AS BIGINT) % 50 <> 2 AS is_current, valid_from, valid_to FROM dim_state
    UNION ALL SELECT customer_id, TRUE, TIMESTAMP '2001-01-01', TIMESTAMP '9999-12-31' FROM dim_state
    WHERE is_current AND CAST(customer_id AS BIGINT) % 50 = 1"""


@query(
    "scd2_integrity_with_faults",
    """SELECT customer_id, count(CASE WHEN is_current THEN 1 END) AS open_versions, count(CASE WHEN next_from < valid_to THEN 1 END) AS overlaps
       FROM (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from, valid_to) AS next_from FROM faulty_versions)
       GROUP BY 1 HAVING count(CASE WHEN is_current THEN 1 END) <> 1 OR count(CASE WHEN next_from < valid_to THEN 1 END) > 0""",
)
def scd2_integrity_with_faults(spark, sf):
    """Some customers get a second open version that overlaps, others lose their open one."""
    number = F.col("customer_id").cast("bigint") % 50
    good = _second(spark, sf).select("customer_id", "is_current", "valid_from", "valid_to")
    doubled = good.where(F.col("is_current") & (number == 1)).withColumn("valid_from", F.lit("2001-01-01").cast("timestamp"))
    closed = good.withColumn("is_current", F.col("is_current") & (number != 2))
    return dims.scd2_problems(closed.unionByName(doubled), "customer_id")


CTES["order_changes"] = """
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderkey, o_orderpriority,
           o_orderdate AS changed_at FROM orders"""


@query(
    "scd2_from_change_log",
    f"""SELECT customer_id, priority, lead(since) OVER w IS NULL AS is_current, {moment("since")} AS valid_from,
               COALESCE({moment("lead(since) OVER w")}, '{OPEN}') AS valid_to
        FROM (SELECT customer_id, o_orderpriority AS priority, changed_at AS since, o_orderkey,
                     lag(o_orderpriority) OVER (PARTITION BY customer_id ORDER BY changed_at, o_orderkey) AS earlier
              FROM order_changes)
        WHERE earlier IS DISTINCT FROM priority
        WINDOW w AS (PARTITION BY customer_id ORDER BY since, o_orderkey)""",
)
def scd2_from_change_log(spark, sf):
    log = testdata.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("timestamp").alias("changed_at"),
        "o_orderkey",
    )
    return dims.scd2_from_changes(
        log, "customer_id", ["changed_at", "o_orderkey"], ["priority"], "changed_at"
    ).drop("row_hash")


@query(
    "scd1_upsert",
    """SELECT COALESCE(n.product_id, f.product_id) AS product_id, COALESCE(n.product_name, f.product_name) AS product_name,
              COALESCE(n.category, f.category) AS category, COALESCE(n.unit_price, f.unit_price) AS unit_price,
              COALESCE(n.supplier_id, f.supplier_id) AS supplier_id,
              CASE WHEN n.product_id IS NULL THEN '1998-01-01 00:00:00.000000'
                   ELSE '1998-07-01 00:00:00.000000' END AS _last_updated
       FROM products_first f FULL JOIN products_next n ON f.product_id = n.product_id""",
)
def scd1_upsert(spark, sf):
    start = dims.scd1_start(testdata.products_first(spark, sf), DAY_1)
    return dims.scd1_apply(start, testdata.products_next(spark, sf), DAY_2)


@query(
    "customers_not_yet_known",
    """SELECT n.customer_id, n.email FROM customers_next n LEFT JOIN customers_first f USING (customer_id)
       WHERE f.customer_id IS NULL""",
)
def customers_not_yet_known(spark, sf):
    return dims.unseen(testdata.customers_next(spark, sf), _first(spark, sf), "customer_id").select(
        "customer_id", "email"
    )


@query(
    "orders_with_valid_customer_version",
    """SELECT d.city, d.email LIKE 'new%' AS renewed, count(*) AS n_orders
       FROM good_orders o LEFT JOIN dim_state d
         ON o.customer_id = d.customer_id AND o.order_ts >= d.valid_from AND o.order_ts < d.valid_to
       GROUP BY 1, 2""",
)
def orders_with_valid_customer_version(spark, sf):
    lake = Lake(spark, sf)
    joined = dims.point_in_time_join(
        lake.orders, _second(spark, sf), "customer_id", "order_ts", ["city", "email"], size=3 * lake.customer_bytes
    )
    return joined.groupBy("city", F.startswith("email", F.lit("new")).alias("renewed")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


# Every order line is a price notice of its part: the newest notice before an order gives the price then known.
CTES["price_notices"] = """
    SELECT l_suppkey % 3 AS region_key, l_shipdate, max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2"""


@query(
    "orders_with_price_then_known",
    f"""SELECT o_orderkey, o.region_key, {rounded("price")} AS price
        FROM (SELECT o_orderkey, o_orderdate, o_custkey % 4 AS region_key FROM orders) o
        ASOF LEFT JOIN price_notices n ON o.region_key = n.region_key AND o.o_orderdate >= n.l_shipdate""",
)
def orders_with_price_then_known(spark, sf):
    """Three keys hold all versions, one for each day: no order may meet all versions of its key."""
    lines = testdata.table(spark, sf, "lineitem")
    notices = lines.groupBy((F.col("l_suppkey") % 3).alias("region_key"), F.col("l_shipdate").cast("timestamp").alias("valid_from")).agg(
        F.max("l_extendedprice").alias("price")
    )
    # A notice holds until the next; their order inside a key is found range by range.
    dated = neighbours(notices, ["region_key"], ["valid_from"], following={"valid_to": "valid_from"})
    dated = dated.withColumn("valid_to", F.coalesce("valid_to", F.lit(OPEN_END).cast("timestamp")))
    orders = testdata.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 4).alias("region_key"), F.col("o_orderdate").cast("timestamp").alias("at")
    )
    joined = dims.point_in_time_join(orders, dated, "region_key", "at", ["price"])
    return joined.select("o_orderkey", "region_key", F.round(F.round("price", 6), 2).alias("price"))


@query(
    "revenue_by_named_region",
    f"""SELECT n_name AS country, r_name AS region, count(*) AS n, {rounded("sum(o_totalprice)")} AS total
        FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def revenue_by_named_region(spark, sf):
    load = lambda name: testdata.table(spark, sf, name)
    orders = load("orders").join(load("customer"), F.col("o_custkey") == F.col("c_custkey"))
    placed = dims.enrich(orders, load("nation"), {"c_nationkey": "n_nationkey"})
    placed = dims.enrich(placed, load("region"), {"n_regionkey": "r_regionkey"})
    return placed.groupBy(F.col("n_name").alias("country"), F.col("r_name").alias("region")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.round(F.sum("o_totalprice"), 6), 2).alias("total")
    )


@query(
    "products_with_category_reference",
    """SELECT p.p_partkey AS product, p.p_type AS category, p.p_brand AS sub_category,
              lower(p.p_type) || ' / ' || p.p_brand AS display_name, p.p_type = 'PROMO' AS is_seasonal FROM part p""",
)
def products_with_category_reference(spark, sf):
    parts = testdata.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product"), F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category")
    )
    reference = parts.select(
        "category",
        "sub_category",
        F.concat_ws(" / ", F.lower("category"), "sub_category").alias("display_name"),
        F.when(F.col("category") == "PROMO", "true").otherwise("false").alias("is_seasonal"),
    ).distinct().withColumn("is_seasonal", F.col("is_seasonal").cast("boolean"))
    return dims.enrich(parts, reference, {"category": "category", "sub_category": "sub_category"})


@query(
    "revenue_with_reference_files",
    f"""SELECT n_name AS region_name, r_name AS country, p_type = 'PROMO' AS is_seasonal, count(*) AS n,
               {rounded("sum(l_extendedprice)")} AS revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""",
)
def revenue_with_reference_files(spark, sf):
    """Lines joined to region and category reference files written as CSV and read back."""
    load = lambda name: testdata.table(spark, sf, name)
    region_file, category_file = scratch_path(spark, "regions"), scratch_path(spark, "categories")
    nations = load("nation").join(load("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    files.export_csv(
        nations.select(
            F.col("n_nationkey").cast("string").alias("region_code"),
            F.col("n_name").alias("region_name"),
            F.col("r_name").alias("country"),
            F.lit("UTC").alias("timezone"),
        ),
        region_file,
    )
    files.export_csv(
        load("part").select(
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
            F.lower("p_type").alias("display_name"),
            F.when(F.col("p_type") == "PROMO", "true").otherwise("false").alias("is_seasonal"),
            F.lit("high").alias("margin_band"),
        ).distinct(),
        category_file,
    )
    regions = files.read_reference(spark, region_file, schemas.REGION_REFERENCE)
    categories = files.read_reference(spark, category_file, schemas.CATEGORY_REFERENCE, ("is_seasonal",))
    lines = load("lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")
    placed = (
        lines.join(load("part").select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(load("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("nation", F.col("s_nationkey").cast("string"))
    )
    named = dims.enrich(placed, regions, {"nation": "region_code"})
    named = dims.enrich(named, categories, {"p_type": "category", "p_brand": "sub_category"})
    return named.groupBy("region_name", "country", "is_seasonal").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.round(F.sum("l_extendedprice"), 6), 2).alias("revenue")
    )


@query(
    "stored_order_split",
    """SELECT count(CASE WHEN NOT bad THEN 1 END) AS accepted, count(CASE WHEN bad THEN 1 END) AS rejected
       FROM (SELECT bad_id OR bad_customer OR bad_product OR bad_price OR bad_time AS bad FROM checked_orders)""",
)
def stored_order_split(spark, sf):
    lake = Lake(spark, sf)
    good, bad = scratch_path(spark, "orders"), scratch_path(spark, "quarantine")
    quality.store_split(lake.checked_orders, lake.orders, good, bad)
    both = snapshots.read(spark, good).select(F.lit(1).alias("a")).unionByName(
        snapshots.read(spark, bad).select(F.lit(1).alias("b")), allowMissingColumns=True
    )
    return both.agg(F.count("a").alias("accepted"), F.count("b").alias("rejected"))


# --- snapshots --------------------------------------------------------------


CHANGE_SQL = """SELECT k.customer_id, CASE WHEN side = 'old' THEN f.email ELSE n.email END AS email,
              CASE WHEN side = 'old' THEN f.city ELSE n.city END AS city,
              CASE WHEN n.customer_id IS NULL THEN 'delete' WHEN f.customer_id IS NULL THEN 'insert'
                   WHEN side = 'old' THEN 'update_preimage' ELSE 'update_postimage' END AS _change_type
       FROM (SELECT customer_id FROM customers_first UNION SELECT customer_id FROM customers_next) k
       LEFT JOIN customers_first f ON k.customer_id = f.customer_id
       LEFT JOIN customers_next n ON k.customer_id = n.customer_id
       JOIN (VALUES ('old'), ('new')) v(side)
         ON (side = 'old' AND f.customer_id IS NOT NULL) OR (side = 'new' AND n.customer_id IS NOT NULL)
       WHERE n.customer_id IS NULL OR f.customer_id IS NULL OR f.email IS DISTINCT FROM n.email
          OR f.city IS DISTINCT FROM n.city"""


@query("customer_change_feed", CHANGE_SQL)
def customer_change_feed(spark, sf):
    shown = ["customer_id", "email", "city"]
    return snapshots.changes(
        testdata.customers_first(spark, sf).select(*shown), testdata.customers_next(spark, sf).select(*shown),
        ["customer_id"],
    )


@query("customer_changes_by_tree", CHANGE_SQL)
def customer_changes_by_tree(spark, sf):
    """The same changes between stored snapshots, read from the key ranges that differ."""
    shown, paths = ["customer_id", "email", "city"], [scratch_path(spark, n) for n in ("before", "after")]
    for path, rows in zip(paths, (testdata.customers_first(spark, sf), testdata.customers_next(spark, sf)), strict=True):
        hashtree.write(rows.select(*shown), path, ["customer_id"], leaves=256, folders=16)
    return hashtree.changes_between(spark, *paths, ["customer_id"], leaves=256, folders=16)


@query(
    "schema_drift_append",
    """SELECT p_partkey AS product, p_name AS name, NULL AS channel FROM part
       UNION ALL SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN 'web' ELSE 'shop' END FROM part""",
)
def schema_drift_append(spark, sf):
    old = testdata.table(spark, sf, "part").select(F.col("p_partkey").alias("product"), F.col("p_name").alias("name"))
    drifted = testdata.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 25, "web").otherwise("shop").alias("channel"),
    )
    return files.widen(old, drifted)


@query(
    "snapshot_versions",
    """SELECT 'v1' AS version, count(*) AS n, round(sum(unit_price), 2) AS total FROM products_first
       UNION ALL SELECT 'v2', count(*), round(sum(unit_price), 2) FROM products_next
       UNION ALL SELECT 'v3', (SELECT count(*) FROM products_next) + (SELECT count(*) FROM products_first),
           round((SELECT sum(unit_price) FROM products_next) + (SELECT sum(unit_price) FROM products_first), 2)""",
)
def snapshot_versions(spark, sf):
    """Overwrite twice, append once, then read each version back."""
    table = scratch_path(spark, "products")
    snapshots.overwrite(testdata.products_first(spark, sf), table)
    snapshots.overwrite(testdata.products_next(spark, sf), table, min_rows=1)
    snapshots.append(testdata.products_first(spark, sf), table)
    parts = [
        snapshots.read(spark, table, version=v).agg(
            F.lit(f"v{v}").alias("version"),
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("unit_price"), 2).alias("total"),
        )
        for v in (1, 2, 3)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "dimension_created_then_merged",
    """SELECT count(*) AS n, count(CASE WHEN n.product_id IS NOT NULL THEN 1 END) AS renewed
       FROM products_first f FULL JOIN products_next n ON f.product_id = n.product_id""",
)
def dimension_created_then_merged(spark, sf):
    table = scratch_path(spark, "dim_products")
    for source, day in ((testdata.products_first(spark, sf), DAY_1), (testdata.products_next(spark, sf), DAY_2)):
        snapshots.upsert_or_create(
            spark,
            table,
            create=lambda s=source, d=day: dims.scd1_start(s, d),
            merge=lambda current, s=source, d=day: dims.scd1_apply(current, s, d),
        )
    return snapshots.read(spark, table).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("_last_updated") == F.lit(DAY_2), 1)).alias("renewed"),
    )


@query(
    "retention_purge",
    """SELECT count(*) AS kept FROM events
       WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
)
def retention_purge(spark, sf):
    log = testdata.model_log(spark, sf)
    kept = snapshots.purge(log, "timestamp", testdata.latest(log, "timestamp"), 7)
    return kept.agg(F.count(F.lit(1)).alias("kept"))


@query(
    "order_months_kept",
    f"""SELECT o_orderkey, {day("m")} AS month, o_totalprice FROM (SELECT *, date_trunc('month', o_orderdate) AS m FROM orders)
        WHERE m >= date_trunc('month', (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY)
          AND (m <> date_trunc('month', (SELECT max(o_orderdate) FROM orders) - INTERVAL 40 DAY) OR o_orderkey % 2 = 0)""",
)
def order_months_kept(spark, sf):
    """A table by month: a first load, late rows appended, one month replaced, months beyond 90 days dropped."""
    table = scratch_path(spark, "order-months")
    orders = testdata.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("month"), F.to_date("o_orderdate").alias("_day")
    )
    newest = orders.agg(F.max("_day")).first()[0]
    late = F.col("o_orderkey") % 10 == 0
    periods.append(orders.where(~late).drop("_day"), table, "month")
    periods.append(orders.where(late).drop("_day"), table, "month")
    redone = (newest - timedelta(days=40)).replace(day=1)
    periods.replace(orders.where((F.col("month") == redone) & (F.col("o_orderkey") % 2 == 0)).drop("_day"), table, "month")
    periods.purge(spark, table, "month", (newest - timedelta(days=90)).replace(day=1))
    return spark.read.parquet(table).select("o_orderkey", "month", "o_totalprice")


@query(
    "compacted_orders",
    """SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders""",
)
def compacted_orders(spark, sf):
    table = scratch_path(spark, "orders-by-customer")
    snapshots.compact(testdata.table(spark, sf, "orders"), table, ["o_custkey", "o_orderdate"], 8)
    return snapshots.read(spark, table).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "incremental_pull",
    """SELECT count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders
       WHERE o_orderdate > TIMESTAMP '1999-06-01'""",
)
def incremental_pull(spark, sf):
    rows = files.changed_rows(testdata.table(spark, sf, "orders"), "o_orderdate", datetime(1999, 6, 1))
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    "customers_csv_round_trip",
    "SELECT customer_id, first_name, last_name, email, phone, city, country, region, segment FROM customers",
)
def customers_csv_round_trip(spark, sf):
    path = scratch_path(spark, "customers-csv")
    rows = testdata.customers(spark, sf).withColumn("signup_date", F.lit("1995-01-01"))
    files.export_csv(rows.select(*schemas.CUSTOMERS_CSV.names), path)
    return files.read_csv(spark, path, schemas.CUSTOMERS_CSV).drop("signup_date")


@query(
    "returns_csv_with_file_lineage",
    "SELECT return_id, refund_amount, TRUE AS has_file FROM returns_raw WHERE return_id IS NOT NULL",
)
def returns_csv_with_file_lineage(spark, sf):
    path = scratch_path(spark, "returns-csv")
    rows = testdata.returns_raw(spark, sf).where(F.col("return_id").isNotNull())
    files.export_csv(rows.select(*schemas.RETURNS_CSV.names), path)
    landed = files.with_lineage(files.read_csv(spark, path, schemas.RETURNS_CSV), DAY_1)
    return landed.select(
        "return_id", "refund_amount", F.endswith("_source_file", F.lit(".csv")).alias("has_file")
    )


@query(
    "product_head_as_json",
    """SELECT '{"product_id":"' || product_id || '","product_name":"' || product_name || '","category":"' || category
              || '","unit_price":' || unit_price || ',"supplier_id":"' || supplier_id || '"}' AS row_json
       FROM products ORDER BY product_id LIMIT 5""",
)
def product_head_as_json(spark, sf):
    return files.head_as_json(testdata.products(spark, sf), 5, ["product_id"])


@query("loaded_at_stamp", f"SELECT count(*) AS n, {moment(_today())} AS _loaded_at FROM part")
def loaded_at_stamp(spark, sf):
    stamped = files.stamped(testdata.products(spark, sf), Lake(spark, sf).as_of)
    return stamped.groupBy("_loaded_at").agg(F.count(F.lit(1)).alias("n"))


@query("key_uniqueness_after_upsert", "SELECT product_id, 0 AS n_rows FROM products WHERE FALSE")
def key_uniqueness_after_upsert(spark, sf):
    start = dims.scd1_start(testdata.products_first(spark, sf), DAY_1)
    merged = dims.scd1_apply(start, testdata.products_next(spark, sf), DAY_2)
    return quality.repeated_keys(merged, ["product_id"])


@query(
    "key_uniqueness_with_faults",
    """SELECT product_id, 2 AS n_rows FROM (SELECT product_id FROM products_first UNION SELECT product_id FROM products_next)
       WHERE CAST(product_id AS BIGINT) % 20 = 3""",
)
def key_uniqueness_with_faults(spark, sf):
    """The merged table with some of its rows put in a second time."""
    start = dims.scd1_start(testdata.products_first(spark, sf), DAY_1)
    merged = dims.scd1_apply(start, testdata.products_next(spark, sf), DAY_2)
    again = merged.where(F.col("product_id").cast("bigint") % 20 == 3)
    return quality.repeated_keys(merged.unionByName(again), ["product_id"])
