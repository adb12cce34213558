"""The five dimensions of the star schema."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.functions import dates, labels
from merchlake.operators import surrogate
from merchlake.plans.lazy import LazyTables, mapped

Tables = Mapping[str, DataFrame]

DATED_SOURCES = [
    "website_sessions",
    "website_pageviews",
    "products",
    "orders",
    "order_items",
    "order_item_refunds",
]


def staging_date_range(staged: Tables) -> DataFrame:
    """One row: first and last day over all six staged tables, NULL when all are empty."""
    ranges = [
        staged[name].agg(
            F.to_date(F.min("created_at")).alias("start_date"),
            F.to_date(F.max("created_at")).alias("end_date"),
        )
        for name in DATED_SOURCES
    ]
    return reduce(DataFrame.unionByName, ranges).agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")
    )


def _calendar(day: Column) -> dict[str, Column]:
    month, weekday = F.month(day), dates.iso_weekday(day)
    return {
        "date_key": dates.date_key(day),
        "date": day,
        "day": F.dayofmonth(day).cast("smallint"),
        "month": month.cast("smallint"),
        "month_name": dates.name_of(dates.MONTH_NAMES, month),
        "quarter": F.quarter(day).cast("smallint"),
        "year": F.year(day).cast("smallint"),
        "day_of_week": weekday.cast("smallint"),
        "day_name": dates.name_of(dates.DAY_NAMES, weekday),
        "is_weekend": weekday >= 6,
    }


def dim_date_between(date_range: DataFrame) -> DataFrame:
    """One row per day of a one-row (start_date, end_date) range; an empty range raises."""
    start, end = F.col("start_date"), F.col("end_date")

    def checked(bound: Column) -> Column:
        # The check sits on the bounds the calendar is made of, so it always runs.
        missing = F.raise_error(F.lit("No calendar can be made of empty staging"))
        reversed_ = F.raise_error(F.lit("The calendar is reversed: start_date lies behind end_date"))
        return (
            F.when(start.isNull() | end.isNull(), missing.cast("date"))
            .when(start > end, reversed_.cast("date"))
            .otherwise(bound)
        )

    days = F.sequence(checked(start), checked(end), F.expr("interval 1 day"))
    calendar = date_range.select(F.explode(days).alias("_day"))
    return calendar.select(*[c.alias(n) for n, c in _calendar(F.col("_day")).items()])


def build_dim_date(spark: SparkSession, start: date, end: date) -> DataFrame:
    if start > end:
        raise ValueError("The calendar is reversed: start_date lies behind end_date")
    bounds = spark.createDataFrame([(start, end)], "start_date date, end_date date")
    return dim_date_between(bounds)


def build_dim_date_from_staging(staged: Tables) -> DataFrame:
    return dim_date_between(staging_date_range(staged))


def product_members(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "created_at")


def customer_members(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per user seen in sessions or orders; buyers without a session are kept."""
    visits = sessions.groupBy("user_id").agg(
        F.min("created_at").alias("first_session_at"),
        F.max("created_at").alias("last_session_at"),
        F.bool_or(F.col("is_repeat_session") == 1).alias("has_repeat_session"),
    )
    purchases = orders.groupBy("user_id").agg(
        F.min("created_at").alias("first_order_at"), F.lit(True).alias("is_buyer")
    )
    return visits.join(purchases, "user_id", "full").select(
        "user_id",
        "first_session_at",
        "last_session_at",
        "first_order_at",
        F.coalesce("has_repeat_session", F.lit(False)).alias("has_repeat_session"),
        F.coalesce("is_buyer", F.lit(False)).alias("is_buyer"),
    )


def marketing_members(sessions: DataFrame) -> DataFrame:
    attributes = labels.MARKETING_ATTRIBUTES
    all_missing = reduce(Column.__and__, [F.col(a).isNull() for a in attributes])
    # Distinct after naming the missing values: a literal '(aucun)' and a NULL are one member.
    return sessions.select(
        *[labels.or_member(a).alias(a) for a in attributes], all_missing.alias("is_direct")
    ).distinct()


def device_members(sessions: DataFrame) -> DataFrame:
    device = F.col("device_type")
    return sessions.select("device_type").distinct().select(
        "device_type",
        labels.device_label(device).alias("device_label"),
        (device == "mobile").alias("is_mobile"),
    )


# Surrogate-keyed dimensions: key column, business key, hash digits for numbering.
KEYED = {
    "dim_product": ("product_key", ["product_id"], surrogate.LARGE),
    "dim_customer": ("customer_key", ["user_id"], surrogate.LARGE),
    "dim_marketing": ("marketing_key", labels.MARKETING_ATTRIBUTES, surrogate.LARGE),
    "dim_device": ("device_key", ["device_type"], surrogate.SMALL),
}


def members(staged: Tables) -> LazyTables:
    """Members of the keyed dimensions, still without surrogate keys."""
    return LazyTables(
        {
            "dim_product": lambda: product_members(staged["products"]),
            "dim_customer": lambda: customer_members(staged["website_sessions"], staged["orders"]),
            "dim_marketing": lambda: marketing_members(staged["website_sessions"]),
            "dim_device": lambda: device_members(staged["website_sessions"]),
        }
    )


def numbered(name: str, dimension_members: DataFrame) -> DataFrame:
    """A keyed dimension built from nothing."""
    key, business_key, digits = KEYED[name]
    return surrogate.assign(dimension_members, business_key, key, digits)


def build_dimensions(staged: Tables, of_members: Tables | None = None) -> LazyTables:
    """``of_members``: the members, where they have been written before."""
    calendar = LazyTables({"dim_date": lambda: build_dim_date_from_staging(staged)})
    return calendar | mapped(members(staged) if of_members is None else of_members, numbered)
