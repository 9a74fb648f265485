"""The registered queries against their SQL on the smallest data."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from tools.check import TABLES, table

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()

CHECKED = [
    "silver_orders_quarantine",
    "gold_revenue_daily_full",
    "gold_customer_metrics",
    "customer_rfm",
    "business_summary",
    "scd2_after_second_load",
    "customer_change_feed",
    "forecast_features",
    "feature_drift",
    "latency_trend",
    "window_chunks",
    "structured_answers",
    "topic_nearest",
    "stream_late_rows",
]


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(CHECKED) <= set(ORACLE)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "num_orders", "gross_revenue", "total_refunds", "net_revenue"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SMALL)
    result = database.execute(ORACLE[name])
    wanted = table([d[0] for d in result.description], result.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == wanted
