"""Column types of every source, staged and control table (never inferred)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = "decimal(12,2)"
# Of a mart: one channel's turnover passes 10 ** 12 at the target volume.
MART_MONEY = "decimal(18,2)"
RATE = "decimal(8,4)"


_TYPES: dict[str, DataType] = {
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
    "timestamp_ntz": TimestampNTZType(),
    "seconds": DecimalType(12, 3),
}


def _schema(columns: str) -> StructType:
    # Built without a running session, so that the module can be imported anywhere.
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


SESSIONS = _schema(
    "website_session_id bigint, created_at timestamp_ntz, user_id bigint, is_repeat_session int, "
    "utm_source string, utm_campaign string, utm_content string, device_type string, "
    "http_referer string"
)
PAGEVIEWS = _schema(
    "website_pageview_id bigint, created_at timestamp_ntz, website_session_id bigint, "
    "pageview_url string"
)
PRODUCTS = _schema("product_id int, created_at timestamp_ntz, product_name string")
ORDERS = _schema(
    "order_id bigint, created_at timestamp_ntz, website_session_id bigint, user_id bigint, "
    "primary_product_id int, items_purchased int, price_usd double, cogs_usd double"
)
ORDER_ITEMS = _schema(
    "order_item_id bigint, created_at timestamp_ntz, order_id bigint, product_id int, "
    "is_primary_item int, price_usd double, cogs_usd double"
)
REFUNDS = _schema(
    "order_item_refund_id bigint, created_at timestamp_ntz, order_item_id bigint, "
    "order_id bigint, refund_amount_usd double"
)

SOURCES = {
    "website_sessions": SESSIONS,
    "website_pageviews": PAGEVIEWS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "order_item_refunds": REFUNDS,
}

STAGED_ORDERS = StructType(ORDERS.fields + _schema("gross_profit double").fields)
STAGED_ORDER_ITEMS = StructType(ORDER_ITEMS.fields + _schema("gross_profit double").fields)

STAGED = dict(SOURCES, orders=STAGED_ORDERS, order_items=STAGED_ORDER_ITEMS)

# One page of the order service: the envelope and the order rows inside it.
_PAGE_ROW = StructType(
    [
        StructField(f.name, StringType() if f.name == "created_at" else f.dataType)
        for f in ORDERS.fields
    ]
)
ORDER_PAGE = StructType(
    [*_schema("total bigint, limit bigint, offset bigint"), StructField("orders", ArrayType(_PAGE_ROW))]
)

WATERMARKS = _schema(
    "pipeline_name string, source_name string, last_created_at timestamp_ntz, last_id bigint, "
    "updated_at timestamp_ntz"
)
ORDER_COMMITS = StructType(
    [*WATERMARKS.fields, *_schema("run bigint, stream string, batch bigint").fields]
)
RUN_LOG = _schema(
    "run_id string, pipeline_name string, logged_at timestamp_ntz, status string, "
    "rows_extracted bigint, rows_loaded bigint, rows_rejected bigint, error_message string"
)
STEP_LOG = _schema(
    "run_id string, step_run_id bigint, step_name string, logged_at timestamp_ntz, status string, "
    "duration_seconds seconds, rows_processed bigint, error_message string"
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns and types of ``schema``, in its order; missing columns raise."""
    missing = sorted(set(schema.fieldNames()) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns: {', '.join(missing)}")
    return df.select(*[_cast(df, f) for f in schema.fields])


def _cast(df: DataFrame, field: StructField) -> Column:
    """Time texts with an offset are instants: they become UTC wall-clock times."""
    column, source = F.col(field.name), df.schema[field.name].dataType
    if isinstance(source, StringType) and isinstance(field.dataType, TimestampNTZType):
        column = F.to_utc_timestamp(column.cast("timestamp"), "UTC")
    return column.cast(field.dataType).alias(field.name)
