"""Turnover of one channel beyond 10 ** 12, as at the target volume."""

from decimal import Decimal

from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.plans import analyses, mart_states, marts
from merchlake.session import configure

PRICE, ITEMS = "9999999999.99", 300


def test_a_channel_sells_for_more_than_a_trillion(spark):
    configure(spark)
    channel = ["1 AS marketing_key", "'g' AS utm_source", "'c' AS utm_campaign", "'x' AS utm_content", "NULL AS http_referer", "false AS is_direct"]
    sessions = spark.range(1, 4).selectExpr(
        "id AS website_session_id", "1 AS marketing_key", "id AS customer_key", "false AS is_repeat_session",
        "1 AS pageview_count", "false AS is_bounce", "true AS is_converted",
    )
    amounts = ["price_usd", "gross_profit_usd", "refund_amount_usd"]
    sales = spark.range(ITEMS).select(
        (1 + F.col("id") % 3).alias("website_session_id"),
        F.floor(F.col("id") / 2).alias("order_id"),
        (F.col("id") % 2 == 0).alias("opens_order"),
        F.lit(202401).alias("month"),
        *[F.lit(PRICE).cast(schemas.MONEY).alias(a) for a in amounts],
    )
    one_session_an_order = sales.withColumn("website_session_id", 1 + F.col("order_id") % 3)
    channels = spark.range(1).selectExpr(*channel)
    mart = marts.marketing_performance(
        {"dim_marketing": channels, "fact_sessions": sessions, "fact_sales": one_session_an_order}
    )
    total = ITEMS * Decimal(PRICE)
    found = mart.first()
    assert (found.gross_revenue_usd, found.net_revenue_usd, found.orders) == (total, 0, ITEMS // 2)
    state = mart_states.sold_by_channel(one_session_an_order, sessions).first()
    assert (state.gross_revenue_usd, state.orders) == (total, ITEMS // 2)
    label = analyses.channel_labels(analyses.analyse_marketing(mart)).first()
    assert label.net_revenue_usd == 0
