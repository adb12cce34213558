"""The two fact tables and the per-session aggregates they share with the marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.functions import dates, labels, numeric
from merchlake.plans.lazy import LazyTables

Tables = Mapping[str, DataFrame]


def _path() -> list[Column]:
    """Page count, first and last page, and the time between them."""
    position = F.struct("created_at", "website_pageview_id")
    elapsed = dates.micros(F.max("created_at")) - dates.micros(F.min("created_at"))
    return [
        F.count("*").cast("int").alias("pageview_count"),
        F.min_by("pageview_url", position).alias("landing_page_url"),
        F.max_by("pageview_url", position).alias("exit_page_url"),
        dates.rounded_seconds(elapsed).alias("duration_seconds"),
    ]


def _steps() -> list[Column]:
    """Which funnel pages were seen; independent flags, not an ordered path."""
    url = F.col("pageview_url")
    return [
        F.bool_or(url.isin(pages)).alias(f"viewed_{step}")
        for step, pages in labels.FUNNEL_PAGES.items()
    ]


# First, last and flags are aggregates, combined before the shuffle: a session of any size
# reaches the reducer as one row per map task.


def pageviews_by_session(pageviews: DataFrame) -> DataFrame:
    return pageviews.groupBy("website_session_id").agg(*_path())


def page_steps_by_session(pageviews: DataFrame) -> DataFrame:
    return pageviews.groupBy("website_session_id").agg(*_steps())


def session_visits(pageviews: DataFrame) -> DataFrame:
    """Path and step flags in one pass over the largest table."""
    return _digest(visit_states(pageviews))


# The digest of a session in parts: any cut of the pageviews gives partial states, and merging the
# states of all parts gives the same digest as one pass over all pageviews.


def visit_states(pageviews: DataFrame, *part: str) -> DataFrame:
    """Per session (and ``part`` columns): count, first and last page with their positions, and step flags."""
    position = F.struct("created_at", "website_pageview_id", "pageview_url")
    return pageviews.groupBy("website_session_id", *part).agg(
        F.count("*").alias("pages"), F.min(position).alias("first"), F.max(position).alias("last"), *_steps()
    )


def merged_states(states: DataFrame) -> DataFrame:
    steps = [F.bool_or(f"viewed_{s}").alias(f"viewed_{s}") for s in labels.FUNNEL_PAGES]
    return states.groupBy("website_session_id").agg(
        F.sum("pages").alias("pages"), F.min("first").alias("first"), F.max("last").alias("last"), *steps
    )


def visits_of(states: DataFrame) -> DataFrame:
    """``session_visits`` out of partial states."""
    return _digest(merged_states(states))


def _digest(whole: DataFrame) -> DataFrame:
    elapsed = dates.micros(F.col("last.created_at")) - dates.micros(F.col("first.created_at"))
    return whole.select(
        "website_session_id",
        F.col("pages").cast("int").alias("pageview_count"),
        F.col("first.pageview_url").alias("landing_page_url"),
        F.col("last.pageview_url").alias("exit_page_url"),
        dates.rounded_seconds(elapsed).alias("duration_seconds"),
        *[f"viewed_{s}" for s in labels.FUNNEL_PAGES],
    )


def orders_by_session(orders: DataFrame) -> DataFrame:
    return orders.groupBy("website_session_id").agg(
        F.count("*").cast("int").alias("order_count"),
        F.sum("items_purchased").cast("int").alias("items_purchased"),
        numeric.exact_sum(F.col("price_usd"), schemas.MONEY).alias("revenue_usd"),
        numeric.exact_sum(F.col("gross_profit"), schemas.MONEY).alias("gross_profit_usd"),
    )


def refunds_by_item(refunds: DataFrame) -> DataFrame:
    return refunds.groupBy("order_item_id").agg(
        numeric.exact_sum(F.col("refund_amount_usd"), schemas.MONEY).alias("refund_amount_usd"),
        F.max("created_at").alias("last_refund_at"),
        F.lit(True).alias("is_refunded"),
    )


def _orders_of_customers(staged: Tables, dims: Tables) -> DataFrame:
    """Customers are looked up per order, so items never shuffle by user."""
    customers = dims["dim_customer"].select("user_id", "customer_key")
    return staged["orders"].select("order_id", "website_session_id", "user_id").join(customers, "user_id").drop("user_id")


_SOLD = ["product_key", "website_session_id", "customer_key"]


def sold_items(staged: Tables, dims: Tables) -> DataFrame:
    """The items that ``fact_sales`` has a row for, with the keys found for them, without building the rows.

    Only ids travel to products and orders, which on large dimensions is a shuffle each.
    """
    products = dims["dim_product"].select("product_id", "product_key")
    items = staged["order_items"].select("order_item_id", "order_id", "product_id").join(products, "product_id")
    return items.join(_orders_of_customers(staged, dims), "order_id").select("order_item_id", *_SOLD)


def _of_lines(*more: str) -> list[str | Column]:
    """Columns of ``fact_sales`` that come from an item and its refund total."""
    refund = numeric.zero_if_null(F.col("refund_amount_usd"), schemas.MONEY)
    price, profit = F.col("price_usd"), F.col("gross_profit")
    return [
        "order_item_id",
        "order_id",
        dates.date_key(F.col("created_at")).alias("date_key"),
        dates.date_key(F.col("last_refund_at")).alias("refund_date_key"),
        "product_key",
        (F.col("is_primary_item") == 1).alias("is_primary_item"),
        F.col("is_refunded").isNotNull().alias("is_refunded"),
        price.cast(schemas.MONEY).alias("price_usd"),
        F.col("cogs_usd").cast(schemas.MONEY).alias("cogs_usd"),
        profit.cast(schemas.MONEY).alias("gross_profit_usd"),
        refund.alias("refund_amount_usd"),
        (numeric.exact(price) - refund).cast(schemas.MONEY).alias("net_revenue_usd"),
        (numeric.exact(profit) - refund).cast(schemas.MONEY).alias("net_profit_usd"),
        *more,
    ]


_SALE = [
    "order_item_id", "order_id", "website_session_id", "date_key", "refund_date_key",
    "product_key", "customer_key", "is_primary_item", "is_refunded", "price_usd", "cogs_usd",
    "gross_profit_usd", "refund_amount_usd", "net_revenue_usd", "net_profit_usd",
]


def fact_sales(staged: Tables, dims: Tables) -> DataFrame:
    """One row per order item; the refund total of an item is dated by its last refund.

    Refunds come first and the order last: the written rows of an order lie together, so they
    compress well and what marts count or add up per order or session is combined before the shuffle.
    """
    products = dims["dim_product"].select("product_id", "product_key")
    lines = (
        staged["order_items"]
        .join(products, "product_id")
        .join(refunds_by_item(staged["order_item_refunds"]), "order_item_id", "left")
    )
    return lines.select(_of_lines()).join(_orders_of_customers(staged, dims), "order_id").select(_SALE)


def fact_sales_of(staged: Tables, sold: DataFrame) -> DataFrame:
    """``fact_sales`` of the items ``sold``, which is ``sold_items`` and may have further columns.

    Whole rows meet what was found for them, and their refunds, in one shuffle by item.
    """
    lines = staged["order_items"].join(sold, "order_item_id").join(
        refunds_by_item(staged["order_item_refunds"]), "order_item_id", "left"
    )
    more = [c for c in sold.columns if c not in ("order_item_id", *_SOLD)]
    return lines.select(_of_lines("website_session_id", "customer_key", *more)).select(*_SALE, *more)


def _keyed_sessions(staged: Tables, dims: Tables) -> DataFrame:
    """Sessions with their texts exchanged for keys."""
    attributes = labels.MARKETING_ATTRIBUTES
    marketing = dims["dim_marketing"].select(
        "marketing_key", *[F.col(a).alias(f"_{a}") for a in attributes]
    )
    same_channel = [labels.or_member(a) == F.col(f"_{a}") for a in attributes]
    return (
        staged["website_sessions"]
        .join(dims["dim_device"].select("device_type", "device_key"), "device_type")
        .join(marketing, same_channel)
        .join(dims["dim_customer"].select("user_id", "customer_key"), "user_id")
        .select(
            "website_session_id", "created_at", "is_repeat_session",
            "device_key", "marketing_key", "customer_key",
        )
    )


def visited_sessions(staged: Tables, dims: Tables, visits: DataFrame) -> DataFrame:
    """(website_session_id) of the sessions that ``fact_sessions`` has a row for."""
    keyed = _keyed_sessions(staged, dims).select("website_session_id")
    return keyed.join(visits.select("website_session_id"), "website_session_id", "left_semi")


def fact_sessions(staged: Tables, dims: Tables, visits: DataFrame, of_sessions: DataFrame | None = None) -> DataFrame:
    """One row per session with pageviews; ``visits`` holds their path by session.

    ``of_sessions`` holds further columns by session, which are joined along with the path.

    Pageviews and orders are aggregated before the joins, so neither multiplies the other.
    Texts are exchanged for keys before the sessions shuffle, once by user and once by session
    for both aggregates; the result is partitioned by its own key.
    """
    purchases = orders_by_session(staged["orders"]).withColumn("_ordered", F.lit(True))
    joined = _keyed_sessions(staged, dims).join(visits, "website_session_id").join(
        purchases, "website_session_id", "left"
    )
    more = [] if of_sessions is None else [c for c in of_sessions.columns if c != "website_session_id"]
    if more:
        joined = joined.join(of_sessions, "website_session_id", "left")
    return joined.select(
        "website_session_id",
        dates.date_key(F.col("created_at")).alias("date_key"),
        "customer_key",
        "marketing_key",
        "device_key",
        F.col("created_at").alias("session_started_at"),
        "landing_page_url",
        "exit_page_url",
        "pageview_count",
        "duration_seconds",
        (F.col("is_repeat_session") == 1).alias("is_repeat_session"),
        (F.col("pageview_count") == 1).alias("is_bounce"),
        F.col("_ordered").isNotNull().alias("is_converted"),
        numeric.zero_if_null(F.col("order_count")).alias("order_count"),
        numeric.zero_if_null(F.col("items_purchased")).alias("items_purchased"),
        numeric.zero_if_null(F.col("revenue_usd"), schemas.MONEY).alias("revenue_usd"),
        numeric.zero_if_null(F.col("gross_profit_usd"), schemas.MONEY).alias("gross_profit_usd"),
        *more,
    )


def build_digests(staged: Tables) -> LazyTables:
    """Intermediate results that a fact and a mart share."""
    return LazyTables({"session_visits": lambda: session_visits(staged["website_pageviews"])})


def build_facts(staged: Tables, dims: Tables, digests: Tables) -> LazyTables:
    return LazyTables(
        {
            "fact_sales": lambda: fact_sales(staged, dims),
            "fact_sessions": lambda: fact_sessions(staged, dims, digests["session_visits"]),
        }
    )
