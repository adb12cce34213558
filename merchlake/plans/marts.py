"""The six business marts.

All follow one shape: aggregate each fact to the mart's grain, hang the aggregates on the
dimension with left joins so that empty members stay, fill with zero, derive nets and ratios.
Facts are aggregated before any of these joins, which therefore move aggregates only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.functions import labels
from merchlake.functions.numeric import amount_rate, count_rate, per_count, zero_if_null
from merchlake.plans.lazy import LazyTables

Tables = Mapping[str, DataFrame]
_MONEY, _RATE = schemas.MART_MONEY, schemas.RATE


def _count(condition: Column | None = None) -> Column:
    return F.count("*") if condition is None else F.count_if(condition)


def _distinct(column: str) -> Column:
    return F.count_distinct(column)


def money(column: str) -> Column:
    return F.sum(column).cast(_MONEY)


def _rate(part: str, whole: str) -> Column:
    return count_rate(F.col(part), F.col(whole), _RATE)


def _per(amount: str, count: str) -> Column:
    return per_count(F.col(amount), F.col(count), _MONEY)


def _value_rate(part: str, whole: str) -> Column:
    return amount_rate(F.col(part), F.col(whole), _RATE)


def _net(amount: str) -> Column:
    return (F.col(amount) - F.col("refund_amount_usd")).cast(_MONEY)


def traffic(sessions: DataFrame, grain: str) -> DataFrame:
    return sessions.groupBy(grain).agg(
        _count().alias("sessions"),
        _distinct("customer_key").alias("unique_visitors"),
        _count(F.col("is_repeat_session")).alias("repeat_sessions"),
        F.sum("pageview_count").alias("pageviews"),
        _count(F.col("is_bounce")).alias("bounces"),
        _count(F.col("is_converted")).alias("converted_sessions"),
    )


def turnover(sales: DataFrame, grain: str, *more: Column) -> DataFrame:
    return sales.groupBy(grain).agg(
        _distinct("order_id").alias("orders"),
        _count().alias("items_purchased"),
        money("price_usd").alias("gross_revenue_usd"),
        money("gross_profit_usd").alias("gross_profit_usd"),
        *more,
    )


def _hang(dimension: DataFrame, key: str, *aggregates: DataFrame) -> DataFrame:
    """Every member of the dimension with its aggregates; missing measures become 0."""
    result = dimension
    for aggregate in aggregates:
        measures = [c for c in aggregate.columns if c != key]
        result = result.join(aggregate, key, "left").withColumns(
            {
                c: zero_if_null(F.col(c))
                for c in measures
                if not aggregate.schema[c].dataType.typeName().startswith("date")
            }
        )
    return result


_TRAFFIC_AND_TURNOVER = [
    "sessions", "unique_visitors", "repeat_sessions", "pageviews", "bounces",
    "converted_sessions", "orders", "items_purchased", "gross_revenue_usd", "gross_profit_usd",
    "refund_amount_usd", "net_revenue_usd", "net_profit_usd", "conversion_rate", "bounce_rate",
    "average_order_value_usd",
]


def _activity_measures(values: DataFrame) -> DataFrame:
    return values.withColumns(
        {
            "net_revenue_usd": _net("gross_revenue_usd"),
            "net_profit_usd": _net("gross_profit_usd"),
            "conversion_rate": _rate("converted_sessions", "sessions"),
            "bounce_rate": _rate("bounces", "sessions"),
            "average_order_value_usd": _per("gross_revenue_usd", "orders"),
        }
    )


def refunds_by_day(sales: DataFrame) -> DataFrame:
    return (
        sales.filter(F.col("refund_date_key").isNotNull())
        .groupBy(F.col("refund_date_key").alias("date_key"))
        .agg(money("refund_amount_usd").alias("refund_amount_usd"))
    )


# A mart's last step takes its aggregates from the facts, or from states that are kept (mart_states).


def daily_of(days: DataFrame, traffic: DataFrame, turnover: DataFrame, refunds: DataFrame) -> DataFrame:
    values = _hang(days.select("date_key", "date"), "date_key", traffic, turnover, refunds)
    return _activity_measures(values).select("date_key", "date", *_TRAFFIC_AND_TURNOVER)


def daily_performance(warehouse: Tables) -> DataFrame:
    """Per day: traffic, turnover by sale date, refunds by refund date."""
    sales, sessions = warehouse["fact_sales"], warehouse["fact_sessions"]
    return daily_of(
        warehouse["dim_date"], traffic(sessions, "date_key"), turnover(sales, "date_key"), refunds_by_day(sales)
    )


def marketing_performance(warehouse: Tables) -> DataFrame:
    """Per channel: a sale, and its refund, belongs to the channel of its session."""
    sessions = warehouse["fact_sessions"]
    return marketing_of(
        warehouse["dim_marketing"],
        traffic(sessions, "marketing_key"),
        turnover_by_channel(warehouse["fact_sales"], sessions),
    )


def turnover_by_channel(sales: DataFrame, sessions: DataFrame) -> DataFrame:
    """Added up per order where the sessions are joined, so orders need no shuffle of their own to be counted.

    An order has one session, and so one channel: counting orders per channel counts each once.
    """
    channels = sessions.select("website_session_id", "marketing_key")
    amounts = ["gross_revenue_usd", "gross_profit_usd", "refund_amount_usd"]
    orders = sales.join(channels, "website_session_id").groupBy("website_session_id", "order_id", "marketing_key").agg(
        _count().alias("items_purchased"),
        *[F.sum(c).alias(a) for c, a in zip(["price_usd", "gross_profit_usd", "refund_amount_usd"], amounts, strict=True)],
    )
    return orders.groupBy("marketing_key").agg(
        _count().alias("orders"), F.sum("items_purchased").alias("items_purchased"), *[money(a).alias(a) for a in amounts]
    )


def marketing_of(channels: DataFrame, traffic: DataFrame, turnover: DataFrame) -> DataFrame:
    members = ["marketing_key", *labels.MARKETING_ATTRIBUTES, "is_direct"]
    values = _hang(channels.select(*members), "marketing_key", traffic, turnover)
    return (
        _activity_measures(values)
        .withColumn("revenue_per_session_usd", _per("gross_revenue_usd", "sessions"))
        .select(*members, *_TRAFFIC_AND_TURNOVER, "revenue_per_session_usd")
    )


def product_performance(warehouse: Tables) -> DataFrame:
    primary = F.col("is_primary_item")
    sold = warehouse["fact_sales"].groupBy("product_key").agg(
        _distinct("order_id").alias("orders"),
        _count().alias("units_sold"),
        _count(primary).alias("primary_items"),
        _count(~primary).alias("secondary_items"),
        _count(F.col("is_refunded")).alias("refunded_items"),
        money("price_usd").alias("gross_revenue_usd"),
        money("cogs_usd").alias("cogs_usd"),
        money("gross_profit_usd").alias("gross_profit_usd"),
        money("refund_amount_usd").alias("refund_amount_usd"),
    )
    return product_of(warehouse["dim_product"], sold)


def product_of(products: DataFrame, sold: DataFrame) -> DataFrame:
    products = products.withColumnRenamed("created_at", "product_created_at")
    return (
        _hang(products, "product_key", sold)
        .withColumns(
            {
                "net_revenue_usd": _net("gross_revenue_usd"),
                "net_profit_usd": _net("gross_profit_usd"),
                "average_selling_price_usd": _per("gross_revenue_usd", "units_sold"),
                "gross_margin_rate": _value_rate("gross_profit_usd", "gross_revenue_usd"),
                "refund_rate": _rate("refunded_items", "units_sold"),
                "secondary_item_rate": _rate("secondary_items", "units_sold"),
            }
        )
        .select(
            "product_key", "product_id", "product_name", "product_created_at", "orders",
            "units_sold", "primary_items", "secondary_items", "refunded_items",
            "gross_revenue_usd", "cogs_usd", "gross_profit_usd", "refund_amount_usd",
            "net_revenue_usd", "net_profit_usd", "average_selling_price_usd",
            "gross_margin_rate", "refund_rate", "secondary_item_rate",
        )
    )


def customer_summary(warehouse: Tables) -> DataFrame:
    visits = warehouse["fact_sessions"].groupBy("customer_key").agg(
        _count().alias("session_count"),
        _count(F.col("is_repeat_session")).alias("repeat_session_count"),
    )
    days = warehouse["dim_date"].select("date_key", "date")
    bought = (
        warehouse["fact_sales"]
        .join(days, "date_key")
        .groupBy("customer_key")
        .agg(
            _distinct("order_id").alias("order_count"),
            _count().alias("items_purchased"),
            F.max("date").alias("last_order_date"),
            money("price_usd").alias("gross_revenue_usd"),
            money("refund_amount_usd").alias("refund_amount_usd"),
            money("net_revenue_usd").alias("lifetime_revenue_usd"),
            money("net_profit_usd").alias("lifetime_profit_usd"),
        )
    )
    return customer_of(warehouse["dim_customer"], visits, bought)


def customer_of(customers: DataFrame, visits: DataFrame, bought: DataFrame) -> DataFrame:
    first_days = F.datediff(F.to_date("first_order_at"), F.to_date("first_session_at"))
    return (
        _hang(customers, "customer_key", visits, bought)
        .withColumns(
            {
                "customer_status": labels.customer_status(F.col("order_count")),
                "average_order_value_usd": _per("gross_revenue_usd", "order_count"),
                "days_to_first_order": first_days,
                "is_repeat_buyer": F.col("order_count") > 1,
            }
        )
        .select(
            "customer_key", "user_id", "first_session_at", "last_session_at", "first_order_at",
            "last_order_date", "customer_status", "session_count", "repeat_session_count",
            "order_count", "items_purchased", "gross_revenue_usd", "refund_amount_usd",
            "lifetime_revenue_usd", "lifetime_profit_usd", "average_order_value_usd",
            "days_to_first_order", "is_repeat_buyer",
        )
    )


def steps_by_day(sessions: DataFrame, page_steps: DataFrame) -> DataFrame:
    return (
        sessions.select("website_session_id", "date_key", "is_converted")
        .join(page_steps, "website_session_id")
        .groupBy("date_key")
        .agg(
            _count().alias("sessions"),
            *[_count(F.col(f"viewed_{s}")).alias(f"{s}_sessions") for s in labels.FUNNEL_PAGES],
            _count(F.col("is_converted")).alias("order_sessions"),
        )
    )


def funnel_performance(warehouse: Tables, page_steps: DataFrame) -> DataFrame:
    """Per day: sessions that saw each funnel page; flags per session first, then days."""
    return funnel_of(warehouse["dim_date"], steps_by_day(warehouse["fact_sessions"], page_steps))


def funnel_of(days: DataFrame, daily: DataFrame) -> DataFrame:
    steps = list(labels.FUNNEL_PAGES)
    volumes = ["sessions", *[f"{s}_sessions" for s in steps], "order_sessions"]
    step_rates = [
        "product_view_rate", "product_click_rate", "cart_rate", "shipping_rate", "billing_rate",
        "checkout_rate",
    ]
    rates = {
        name: _rate(part, whole)
        for name, part, whole in zip(step_rates, volumes[1:], volumes[:-1], strict=True)
    }
    rates["conversion_rate"] = _rate("order_sessions", "sessions")
    return (
        _hang(days.select("date_key", "date"), "date_key", daily)
        .withColumns(rates)
        .select("date_key", "date", *volumes, *rates)
    )


def refunds_performance(warehouse: Tables) -> DataFrame:
    sales = warehouse["fact_sales"]
    sold = sales.groupBy("product_key").agg(
        _distinct("order_id").alias("orders"),
        _count().alias("items_sold"),
        money("price_usd").alias("gross_revenue_usd"),
    )
    refund_days = warehouse["dim_date"].select(
        F.col("date_key").alias("refund_date_key"), F.col("date").alias("refund_date")
    )
    refunded = (
        sales.filter("is_refunded")
        .join(refund_days, "refund_date_key")
        .groupBy("product_key")
        .agg(
            _count().alias("items_refunded"),
            F.min("refund_date").alias("first_refund_date"),
            F.max("refund_date").alias("last_refund_date"),
            money("refund_amount_usd").alias("refund_amount_usd"),
        )
    )
    return refunds_of(warehouse["dim_product"], sold, refunded)


def refunds_of(products: DataFrame, *aggregates: DataFrame) -> DataFrame:
    products = products.select("product_key", "product_id", "product_name")
    return (
        _hang(products, "product_key", *aggregates)
        .withColumns(
            {
                "net_revenue_usd": _net("gross_revenue_usd"),
                "average_refund_amount_usd": _per("refund_amount_usd", "items_refunded"),
                "refund_rate": _rate("items_refunded", "items_sold"),
                "refund_value_rate": _value_rate("refund_amount_usd", "gross_revenue_usd"),
            }
        )
        .select(
            "product_key", "product_id", "product_name", "orders", "items_sold",
            "items_refunded", "first_refund_date", "last_refund_date", "gross_revenue_usd",
            "refund_amount_usd", "net_revenue_usd", "average_refund_amount_usd", "refund_rate",
            "refund_value_rate",
        )
    )


def build_marts(warehouse: Tables, digests: Tables) -> LazyTables:
    return LazyTables(
        {
            "daily_performance": lambda: daily_performance(warehouse),
            "marketing_performance": lambda: marketing_performance(warehouse),
            "product_performance": lambda: product_performance(warehouse),
            "customer_summary": lambda: customer_summary(warehouse),
            "funnel_performance": lambda: funnel_performance(
                warehouse, digests["session_visits"]
            ),
            "refunds_performance": lambda: refunds_performance(warehouse),
        }
    )


MART_KEYS = {
    "daily_performance": ["date_key"],
    "marketing_performance": ["marketing_key"],
    "product_performance": ["product_key"],
    "customer_summary": ["customer_key"],
    "funnel_performance": ["date_key"],
    "refunds_performance": ["product_key"],
}
