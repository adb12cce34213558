"""Rules of the six entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.functions.labels import DEVICE_TYPES
from merchlake.operators.rules import (
    is_in_set,
    is_non_negative,
    is_positive,
    not_empty_string,
    not_null,
)
from merchlake.operators.split import Membership, Split, split


def validate_sessions(sessions: DataFrame) -> Split:
    """The device is checked as delivered, before normalisation; marketing may be absent."""
    return split(
        sessions,
        "website_session_id",
        not_null("website_session_id"),
        not_null("user_id"),
        is_in_set("device_type", DEVICE_TYPES),
    )


def validate_pageviews(pageviews: DataFrame) -> Split:
    return split(
        pageviews,
        "website_pageview_id",
        not_null("website_session_id"),
        not_empty_string("pageview_url"),
        not_null("created_at"),
    )


def validate_pageview_chunks(chunks: DataFrame) -> Split:
    """Pageviews with ``file``, ``row`` and ``chunk``: an id may come once per chunk, its first row counts."""
    keyed = chunks.select(
        "row", "file", "chunk", *schemas.PAGEVIEWS.fieldNames(),
        F.struct("file", "chunk", "website_pageview_id").alias("_key_in_chunk"),
    )
    return split(
        keyed,
        "_key_in_chunk",
        not_null("website_session_id"),
        not_empty_string("pageview_url"),
        not_null("created_at"),
    )


def validate_products(products: DataFrame) -> Split:
    return split(products, "product_id", not_empty_string("product_name"), not_null("created_at"))


def validate_orders(orders: DataFrame) -> Split:
    return split(
        orders,
        "order_id",
        not_null("website_session_id"),
        not_null("user_id"),
        is_positive("items_purchased"),
        is_non_negative("price_usd"),
        is_non_negative("cogs_usd"),
    )


def validate_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> Split:
    """``orders``: everything staged so far; ``products``: this run's valid products."""
    return split(
        items,
        "order_item_id",
        is_non_negative("price_usd"),
        is_non_negative("cogs_usd"),
        members=[
            Membership("order_id", orders, "order_id"),
            Membership("product_id", products, "product_id"),
        ],
    )


def validate_refunds(refunds: DataFrame, items: DataFrame, orders: DataFrame) -> Split:
    """``items``: this run's valid items; ``orders``: everything staged so far."""
    return split(
        refunds,
        "order_item_refund_id",
        is_non_negative("refund_amount_usd"),
        members=[
            Membership("order_item_id", items, "order_item_id"),
            Membership("order_id", orders, "order_id"),
        ],
    )
