"""Normalisation of valid rows; each is a single projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.functions.text import strip, strip_lower


def _moment(df: DataFrame) -> DataFrame:
    # Text dates are parsed; under ANSI rules an unreadable one raises.
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def _with_margin(df: DataFrame) -> DataFrame:
    price, cost = F.col("price_usd").cast("double"), F.col("cogs_usd").cast("double")
    return _moment(df).withColumns(
        {"price_usd": price, "cogs_usd": cost, "gross_profit": price - cost}
    )


def transform_orders(orders: DataFrame) -> DataFrame:
    return _with_margin(orders)


def transform_order_items(items: DataFrame) -> DataFrame:
    return _with_margin(items)


def transform_sessions(sessions: DataFrame) -> DataFrame:
    """Case and outer whitespace must not create categories; the referrer is left alone."""
    lowered = ["utm_source", "utm_campaign", "utm_content", "device_type"]
    return _moment(sessions).withColumns({c: strip_lower(F.col(c)) for c in lowered})


def transform_pageviews(pageviews: DataFrame) -> DataFrame:
    return _moment(pageviews)


def transform_products(products: DataFrame) -> DataFrame:
    return _moment(products).withColumn("product_name", strip(F.col("product_name")))


def transform_refunds(refunds: DataFrame) -> DataFrame:
    return _moment(refunds).withColumn(
        "refund_amount_usd", F.col("refund_amount_usd").cast("double")
    )


TRANSFORMS = {
    "website_sessions": transform_sessions,
    "website_pageviews": transform_pageviews,
    "products": transform_products,
    "orders": transform_orders,
    "order_items": transform_order_items,
    "order_item_refunds": transform_refunds,
}
