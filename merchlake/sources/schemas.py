"""Column layouts of the incoming files and tables (fixed values)."""

from pyspark.sql import types as T


_KINDS = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BINARY": T.BinaryType(),
    "TIMESTAMP": T.TimestampType(),
}


def _layout(text: str) -> T.StructType:
    """`name KIND [NOT NULL]` entries to a schema, without needing a session."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(f[0], _KINDS[f[1]], len(f) == 2) for f in fields])


CUSTOMERS_CSV = _layout(
    "customer_id STRING NOT NULL, first_name STRING, last_name STRING, email STRING, phone STRING, "
    "city STRING, country STRING, region STRING, segment STRING, signup_date STRING"
)
ORDER_EVENT = _layout(
    "order_id STRING, customer_id STRING, product_id STRING, quantity INT, unit_price DOUBLE, order_ts STRING"
)
RETURNS_CSV = _layout(
    "return_id STRING NOT NULL, order_id STRING NOT NULL, customer_id STRING NOT NULL, "
    "product_id STRING NOT NULL, return_date STRING, reason_code STRING, refund_amount DOUBLE"
)
PRODUCTS = _layout("product_id STRING, product_name STRING, category STRING, unit_price DOUBLE, supplier_id STRING")
REGION_REFERENCE = _layout("region_code STRING NOT NULL, region_name STRING, country STRING, timezone STRING")
CATEGORY_REFERENCE = _layout(
    "category STRING NOT NULL, sub_category STRING NOT NULL, display_name STRING, is_seasonal STRING, "
    "margin_band STRING"
)
ENVELOPE = _layout("value BINARY, partition INT, offset BIGINT, timestamp TIMESTAMP")
