"""One key holds a third of the rows: same results, and Spark cuts the key's partition."""

from contextlib import contextmanager

import duckdb
import pytest
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.operators.split import split
from merchlake.operators.rules import is_non_negative
from merchlake.plans import dimensions, facts, marts
from merchlake.plans.staging import transform_all

ROWS = 9000


@contextmanager
def settings(spark, **values):
    """Settings under which small test data behaves like large data."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST_SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def hot_shop(spark):
    """User 0, session 0 and order 0 own a third of the sessions, pageviews and items."""
    n = spark.range(ROWS, numPartitions=6)
    hot = F.col("id") % 3 == 0
    moment = F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id") * 60).cast("timestamp_ntz")
    number = F.col("id")
    sessions = n.select(
        number.alias("website_session_id"), moment.alias("created_at"),
        F.when(hot, 0).otherwise(number).alias("user_id"), (number % 2).alias("is_repeat_session"),
        F.lit(None).alias("utm_source"), F.lit(None).alias("utm_campaign"),
        F.lit(None).alias("utm_content"), F.lit("mobile").alias("device_type"),
        F.lit(None).alias("http_referer"),
    )
    own = n.select(
        number.alias("website_pageview_id"), moment.alias("created_at"),
        number.alias("website_session_id"), F.lit("/products").alias("pageview_url"),
    )
    extra = n.filter(number % 2 == 0).select(
        (number + ROWS).alias("website_pageview_id"), moment.alias("created_at"),
        F.lit(0).alias("website_session_id"), F.concat(F.lit("/p"), number).alias("pageview_url"),
    )
    orders = n.select(
        number.alias("order_id"), moment.alias("created_at"), number.alias("website_session_id"),
        F.when(hot, 0).otherwise(number).alias("user_id"), F.lit(1).alias("primary_product_id"),
        F.lit(1).alias("items_purchased"), F.lit(10.0).alias("price_usd"), F.lit(4.0).alias("cogs_usd"),
    )
    items = n.select(
        number.alias("order_item_id"), moment.alias("created_at"),
        F.when(hot, 0).otherwise(number).alias("order_id"), (number % 7).alias("product_id"),
        F.lit(1).alias("is_primary_item"), F.lit(10.0).alias("price_usd"), F.lit(4.0).alias("cogs_usd"),
    )
    refunds = items.filter(number % 5 == 0).select(
        F.col("order_item_id").alias("order_item_refund_id"), "created_at", "order_item_id",
        "order_id", F.lit(1.0).alias("refund_amount_usd"),
    )
    products = spark.range(7).select(
        F.col("id").alias("product_id"), F.lit("2026-01-01 00:00:00").alias("created_at"),
        F.concat(F.lit("p"), F.col("id")).alias("product_name"),
    )
    raw = {
        "website_sessions": sessions, "website_pageviews": own.unionByName(extra),
        "products": products, "orders": orders, "order_items": items,
        "order_item_refunds": refunds,
    }
    return dict(transform_all({k: schemas.conform(v, schemas.SOURCES[k]) for k, v in raw.items()}))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_and_user_in_sales(spark, hot_shop):
    with settings(spark, **NO_BROADCAST_SMALL_SKEW):
        dims = dimensions.build_dimensions(hot_shop)
        sales = facts.fact_sales(hot_shop, dims)
        rows = sales.collect()
        assert "skew=true" in final_plan(sales)
    assert len(rows) == ROWS
    assert sum(r.order_id == 0 for r in rows) == ROWS // 3
    assert sum(r.is_refunded for r in rows) == ROWS // 5
    assert len({r.order_item_id for r in rows}) == ROWS


def test_hot_session_and_user_in_sessions_and_marts(spark, hot_shop):
    with settings(spark, **NO_BROADCAST_SMALL_SKEW):
        dims = dimensions.build_dimensions(hot_shop)
        visits = facts.session_visits(hot_shop["website_pageviews"])
        sessions = facts.fact_sessions(hot_shop, dims, visits)
        rows = {r.website_session_id: r for r in sessions.collect()}
        assert "skew=true" in final_plan(sessions)
        warehouse = dims | facts.build_facts(hot_shop, dims, {"session_visits": visits})
        customers = marts.customer_summary(warehouse).collect()
        channel = marts.marketing_performance(warehouse).first()
    assert len(rows) == ROWS
    assert rows[0].pageview_count == 1 + ROWS // 2
    assert (rows[0].landing_page_url, rows[0].exit_page_url) == ("/products", f"/p{ROWS - 2}")
    hot = next(c for c in customers if c.user_id == 0)
    assert (hot.session_count, hot.order_count) == (ROWS // 3, 1)
    assert (channel.sessions, channel.orders) == (ROWS, 1 + ROWS * 2 // 3)
    assert channel.unique_visitors == 1 + ROWS * 2 // 3


def test_hot_key_split_against_brute_force(spark, hot_shop):
    items = hot_shop["order_items"].select(
        F.col("order_id").alias("id"), F.col("product_id").alias("a"),
        F.when(F.col("order_item_id") % 4 != 0, F.col("order_item_id") % 11).alias("b"),
    )
    frame = items.toPandas()
    expected = duckdb.sql(
        "SELECT id, a, b FROM (SELECT *, row_number() OVER (PARTITION BY id "
        "ORDER BY a NULLS FIRST, b NULLS FIRST) AS n FROM frame) WHERE n = 1 AND b >= 0"
    ).fetchall()
    with settings(spark, **NO_BROADCAST_SMALL_SKEW):
        parts = split(items, "id", is_non_negative("b"))
        valid = [tuple(r) for r in parts.valid.collect()]
        rejected = parts.rejected.count()
    assert sorted(valid) == sorted(expected)
    assert len(valid) + rejected == ROWS
    assert len(frame) == ROWS
