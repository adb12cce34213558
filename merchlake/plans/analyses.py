"""Business analyses over the marts, and the headline figures drawn from them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.functions import dates, labels
from merchlake.functions.numeric import plain_ratio
from merchlake.operators.tables import export_csv
from merchlake.plans.lazy import LazyTables

Tables = Mapping[str, DataFrame]


def _sums(*columns: str) -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns]


def _ratio(numerator: str, denominator: str) -> Column:
    return plain_ratio(F.col(numerator), F.col(denominator))


def analyse_sales(daily: DataFrame) -> DataFrame:
    """Months in order; rates are recomputed from the monthly sums."""
    return (
        daily.groupBy(dates.month_label(F.col("date")).alias("month"))
        .agg(
            *_sums(
                "sessions", "orders", "gross_revenue_usd", "refund_amount_usd",
                "net_revenue_usd", "net_profit_usd",
            )
        )
        .withColumns(
            {
                "conversion_rate": _ratio("orders", "sessions"),
                "average_order_value_usd": _ratio("gross_revenue_usd", "orders"),
            }
        )
        .orderBy("month")
    )


def analyse_customers(customers: DataFrame) -> DataFrame:
    """Segments by revenue."""
    return (
        customers.groupBy("customer_status")
        .agg(
            F.count("user_id").alias("customers"),
            F.sum("order_count").alias("orders"),
            *_sums("lifetime_revenue_usd", "lifetime_profit_usd"),
        )
        .withColumn("revenue_per_customer_usd", _ratio("lifetime_revenue_usd", "customers"))
        .orderBy(F.desc("lifetime_revenue_usd"), "customer_status")
    )


def analyse_marketing(marketing: DataFrame) -> DataFrame:
    """Channels by net revenue, then sessions; a missing source or campaign is a group."""
    return (
        marketing.groupBy("utm_source", "utm_campaign", "is_direct")
        .agg(*_sums("sessions", "orders", "net_revenue_usd", "net_profit_usd"))
        .withColumns(
            {
                "conversion_rate": _ratio("orders", "sessions"),
                "revenue_per_session_usd": _ratio("net_revenue_usd", "sessions"),
            }
        )
        .orderBy(
            F.desc("net_revenue_usd"), F.desc("sessions"), "utm_source", "utm_campaign", "is_direct"
        )
    )


def analyse_funnel(funnel: DataFrame) -> DataFrame:
    """Seven rows: volume of each stage, its share of the previous stage and of the start."""
    columns = [column for _, column in labels.FUNNEL_STAGES]
    totals = funnel.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])

    def share(part: str, whole: str | None, when_empty: float) -> Column:
        if whole is None:
            return F.lit(when_empty)
        return F.coalesce(
            F.col(part).cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0)),
            F.lit(when_empty),
        )

    stages = [
        F.struct(
            F.lit(number).alias("stage_number"),
            F.lit(stage).alias("stage"),
            F.col(column).alias("sessions"),
            share(column, previous, 1.0).alias("rate_from_previous"),
            share(column, columns[0], 0.0).alias("rate_from_start"),
        )
        for number, ((stage, column), previous) in enumerate(
            zip(labels.FUNNEL_STAGES, [None, *columns[:-1]], strict=True), start=1
        )
    ]
    return totals.select(F.inline(F.array(*stages)))


def analyse_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name", "orders", "units_sold", "net_revenue_usd",
        "net_profit_usd", "gross_margin_rate", "refund_rate",
    ).orderBy(F.desc("net_revenue_usd"), "product_id")


def build_analyses(marts: Tables) -> LazyTables:
    return LazyTables(
        {
            "sales_monthly": lambda: analyse_sales(marts["daily_performance"]),
            "customer_segments": lambda: analyse_customers(marts["customer_summary"]),
            "marketing_channels": lambda: analyse_marketing(marts["marketing_performance"]),
            "funnel_overall": lambda: analyse_funnel(marts["funnel_performance"]),
            "product_performance": lambda: analyse_products(marts["product_performance"]),
        }
    )


# Analyses with a fixed number of rows (segments, stages) or one per month.
_BOUNDED = {"sales_monthly", "customer_segments", "funnel_overall"}


def export_analyses(analyses: Tables, folder: str) -> None:
    """Every analysis as CSV under ``folder/<name>``.

    Bounded ones become one file. Channels and products grow with the shop, so they are written
    in parallel; the numbered part files follow the sort order.
    """
    for name, rows in analyses.items():
        export_csv(rows, f"{folder}/{name}", single_file=name in _BOUNDED)


def channel_labels(channels: DataFrame) -> DataFrame:
    """Chart labels of the channel analysis."""
    label = labels.channel_label(F.col("utm_source"), F.col("utm_campaign"), F.col("is_direct"))
    return channels.select(label.alias("label"), "net_revenue_usd")


def top_month(sales_monthly: DataFrame) -> DataFrame:
    """Month with the highest net revenue, the earliest on a tie."""
    return sales_monthly.orderBy(F.desc("net_revenue_usd"), "month").limit(1)


def top_channel(channels: DataFrame) -> DataFrame:
    return channels.orderBy(
        F.desc("net_revenue_usd"), F.desc("sessions"), "utm_source", "utm_campaign", "is_direct"
    ).limit(1)


def top_product(products: DataFrame) -> DataFrame:
    """Product with the highest net revenue."""
    return products.orderBy(F.desc("net_revenue_usd"), "product_id").limit(1)


def headline_metrics(analyses: Tables) -> DataFrame:
    """Five (metric, label, amount) rows behind the written summary.

    Without repeat buyers their row has a NULL label and amount.
    """
    month = top_month(analyses["sales_monthly"]).select(
        F.lit("best_month").alias("metric"), F.col("month").alias("label"), _amount("net_revenue_usd")
    )
    repeat = (
        analyses["customer_segments"]
        .filter(F.col("customer_status") == labels.REPEAT_BUYER)
        .agg(F.max("customers").alias("_n"), F.max("revenue_per_customer_usd").alias("_revenue"))
        .select(
            F.lit("repeat_buyers").alias("metric"),
            F.col("_n").cast("string").alias("label"),
            _amount("_revenue"),
        )
    )
    source = F.coalesce("utm_source", F.lit(labels.NO_SOURCE_LABEL))
    campaign = F.coalesce("utm_campaign", F.lit(labels.NO_CAMPAIGN_LABEL))
    channel = top_channel(analyses["marketing_channels"]).select(
        F.lit("top_channel").alias("metric"),
        F.concat(source, F.lit(" / "), campaign).alias("label"),
        _amount("net_revenue_usd"),
    )
    last_stage = labels.FUNNEL_STAGES[-1][0]
    conversion = (
        analyses["funnel_overall"]
        .filter(F.col("stage") == last_stage)
        .select(
            F.lit("funnel_conversion").alias("metric"),
            F.col("stage").alias("label"),
            _amount("rate_from_start"),
        )
    )
    product = top_product(analyses["product_performance"]).select(
        F.lit("top_product").alias("metric"),
        F.col("product_name").alias("label"),
        _amount("net_profit_usd"),
    )
    return reduce(DataFrame.unionByName, [month, repeat, channel, conversion, product])


def _amount(column: str) -> Column:
    return F.col(column).cast("double").alias("amount")
