"""Marts kept up to date by differences: per mart key and month, the aggregates of that month's facts.

A run aggregates the facts of the months it has written and replaces these months' states: the old
contribution goes out, the new one comes in. A mart then adds up its states and never reads the facts
of other months. Everything in a state can be merged:

* counts and amounts are added, first and last days compared;
* orders are counted by the fact's flags (first item of an order, or of an order and product), so
  an order whose items lie in two months still counts once;
* distinct visitors of a channel are bitmaps over the dense customer keys, merged by OR;
* a day lies in one month, so whatever is counted per day is final.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from merchlake.operators.constraints import guard
from merchlake.operators.monthly import MonthlyTable
from merchlake.plans import marts
from merchlake.plans.lazy import LazyTables, side_by_side
from merchlake.plans.monthly_facts import MonthlyFacts, Refresh

Tables = Mapping[str, DataFrame]


def bitmaps(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Per ``keys`` and bucket of 32,768 numbers: which numbers ``member`` takes, as a bitmap of 4 KB.

    ``member`` is a dense whole number from 1 on. Bitmaps of parts are merged by ``merged_bitmaps``.
    """
    bucket, position = (F.call_function(f, F.col(member)) for f in ("bitmap_bucket_number", "bitmap_bit_position"))
    return rows.groupBy(*keys, bucket.alias("bucket")).agg(F.call_function("bitmap_construct_agg", position).alias("bitmap"))


def merged_bitmaps(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys, "bucket").agg(F.call_function("bitmap_or_agg", F.col("bitmap")).alias("bitmap"))


def bitmap_counts(parts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct members per ``keys``."""
    return merged_bitmaps(parts, keys).groupBy(*keys).agg(F.sum(F.call_function("bitmap_count", F.col("bitmap"))).alias(name))


Merge = Callable[[str], Column]

#: The states each mart is put together from.
STATES_OF = {
    "daily_performance": ["day_traffic", "day_turnover", "day_refunds"],
    "marketing_performance": ["channel_traffic", "channel_visitors", "channel_sales"],
    "product_performance": ["product_sales"],
    "customer_summary": ["customer_visits", "customer_sales"],
    "funnel_performance": ["day_steps"],
    "refunds_performance": ["product_sales"],
}
#: States made of one fact only; the others are made of both.
OF_SALES = {"day_turnover", "day_refunds", "product_sales", "customer_sales"}
OF_SESSIONS = {"day_traffic", "day_steps", "channel_traffic", "channel_visitors", "customer_visits"}


def _added(*columns: str) -> dict[str, Merge]:
    return dict.fromkeys(columns, F.sum)


def _amounts(*columns: str) -> dict[str, Merge]:
    return dict.fromkeys(columns, marts.money)


def _orders(flag: str) -> Column:
    return F.count_if(F.col(flag)).alias("orders")


# How the columns of a state are merged over months.
_TRAFFIC = _added("sessions", "repeat_sessions", "pageviews", "bounces", "converted_sessions")
_TURNOVER = _added("orders", "items_purchased") | _amounts("gross_revenue_usd", "gross_profit_usd", "refund_amount_usd")
_PRODUCTS = (
    _added("orders", "units_sold", "primary_items", "secondary_items", "refunded_items")
    | _amounts("gross_revenue_usd", "cogs_usd", "gross_profit_usd", "refund_amount_usd")
    | {"first_refund": F.min, "last_refund": F.max}
)
_BOUGHT = (
    _added("order_count", "items_purchased")
    | _amounts("gross_revenue_usd", "refund_amount_usd", "lifetime_revenue_usd", "lifetime_profit_usd")
    | {"last_day": F.max}
)


def _day_of(date_key: Column) -> Column:
    return F.make_date(F.floor(date_key / 10000).cast("int"), F.floor(date_key / 100).cast("int") % 100, date_key % 100)


def sold_by_product(sales: DataFrame) -> DataFrame:
    primary = F.col("is_primary_item")
    return sales.groupBy("product_key", "month").agg(
        _orders("opens_order_of_product"),
        F.count("*").alias("units_sold"),
        F.count_if(primary).alias("primary_items"),
        F.count_if(~primary).alias("secondary_items"),
        F.count_if(F.col("is_refunded")).alias("refunded_items"),
        marts.money("price_usd").alias("gross_revenue_usd"),
        marts.money("cogs_usd").alias("cogs_usd"),
        marts.money("gross_profit_usd").alias("gross_profit_usd"),
        marts.money("refund_amount_usd").alias("refund_amount_usd"),
        F.min("refund_date_key").alias("first_refund"),
        F.max("refund_date_key").alias("last_refund"),
    )


def bought_by_customer(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_key", "month").agg(
        _orders("opens_order").alias("order_count"),
        F.count("*").alias("items_purchased"),
        marts.money("price_usd").alias("gross_revenue_usd"),
        marts.money("refund_amount_usd").alias("refund_amount_usd"),
        marts.money("net_revenue_usd").alias("lifetime_revenue_usd"),
        marts.money("net_profit_usd").alias("lifetime_profit_usd"),
        F.max("date_key").alias("last_day"),
    )


def sold_by_channel(sales: DataFrame, sessions: DataFrame) -> DataFrame:
    channels = sessions.select("website_session_id", "marketing_key")
    return sales.join(channels, "website_session_id").groupBy("marketing_key", "month").agg(
        _orders("opens_order"),
        F.count("*").alias("items_purchased"),
        marts.money("price_usd").alias("gross_revenue_usd"),
        marts.money("gross_profit_usd").alias("gross_profit_usd"),
        marts.money("refund_amount_usd").alias("refund_amount_usd"),
    )


def _with_month(of_days: DataFrame) -> DataFrame:
    return of_days.withColumn("month", F.floor(F.col("date_key") / 100).cast("int"))


def _visits(sessions: DataFrame, *keys: str) -> DataFrame:
    return sessions.groupBy(*keys).agg(
        F.count("*").alias("session_count"), F.count_if(F.col("is_repeat_session")).alias("repeat_session_count")
    )


def refunds_of_months(sales: DataFrame) -> DataFrame:
    """Refunds per refund day and month of the sale."""
    refunded = sales.filter(F.col("refund_date_key").isNotNull())
    return refunded.groupBy(F.col("refund_date_key").alias("date_key"), "month").agg(
        marts.money("refund_amount_usd").alias("refund_amount_usd")
    )


class MartStates:
    """States of all marts beside the monthly facts of ``facts``."""

    def __init__(self, spark: SparkSession, facts: MonthlyFacts) -> None:
        self.spark, self.facts = spark, facts
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> MonthlyTable:
        return MonthlyTable(f"{self.facts.root}/states/{name}")

    def read(self, name: str) -> DataFrame:
        return self.table(name).read(self.spark, self._schemas[name])

    def _replace(self, name: str, months: list[int], state: Callable[[list[int]], DataFrame]) -> None:
        rows = state(months)
        self._schemas[name] = rows.schema
        if months:
            self.table(name).write(guard(rows, name, ["month"], highest=F.lit(None).cast("bigint")), months)
            self.table(name).drop_old(self.spark)

    def refresh(
        self, sales: Refresh | None, sessions: Refresh | None, page_steps: DataFrame | None, names: Iterable[str] | None = None
    ) -> None:
        """Replaces the states of the months that ``sales`` and ``sessions`` have written.

        With ``names`` only these states; a fact that none of them is made of may be None.
        """
        facts = self.facts
        wanted = OF_SALES | OF_SESSIONS | {"channel_sales"} if names is None else set(names)

        def sold(months: list[int]) -> DataFrame:
            return facts.read("fact_sales", months, sales.run)

        def visited(months: list[int] | None) -> DataFrame:
            return facts.read("fact_sessions", months, sessions.run)

        of_sales = {
            "day_turnover": lambda m: _with_month(marts.turnover(sold(m), "date_key")),
            "day_refunds": lambda m: refunds_of_months(sold(m)),
            "product_sales": lambda m: sold_by_product(sold(m)),
            "customer_sales": lambda m: bought_by_customer(sold(m)),
        }
        of_sessions = {
            "day_traffic": lambda m: _with_month(marts.traffic(visited(m), "date_key")),
            "day_steps": lambda m: _with_month(marts.steps_by_day(visited(m), page_steps)),
            "channel_traffic": lambda m: visited(m).groupBy("marketing_key", "month").agg(
                F.count("*").alias("sessions"),
                F.count_if(F.col("is_repeat_session")).alias("repeat_sessions"),
                F.sum("pageview_count").alias("pageviews"),
                F.count_if(F.col("is_bounce")).alias("bounces"),
                F.count_if(F.col("is_converted")).alias("converted_sessions"),
            ),
            "channel_visitors": lambda m: bitmaps(visited(m), ["marketing_key", "month"], "customer_key"),
            "customer_visits": lambda m: _visits(visited(m), "customer_key", "month"),
        }
        work = {n: (sales.months, s) for n, s in of_sales.items() if n in wanted}
        work |= {n: (sessions.months, s) for n, s in of_sessions.items() if n in wanted}
        side_by_side(lambda name: self._replace(name, *work[name]), work)
        if "channel_sales" not in wanted:
            return
        # A sale belongs to its session's channel, so sales of changed sessions change too.
        # Only months that the sales have not written anyway are looked through for them.
        others = sorted(set(facts.table("fact_sales").months(self.spark, sales.run)) - set(sales.months))
        moved = []
        if others:
            stored = sold(others).select(F.col("website_session_id").alias("key"), "month")
            moved = stored.join(sessions.changed, "key", "left_semi").select("month").distinct().collect()
        months = sorted({r.month for r in moved} | set(sales.months))
        self._replace("channel_sales", months, lambda m: sold_by_channel(sold(m), visited(None)))

    def _merged(self, name: str, key: str, measures: Mapping[str, Merge]) -> DataFrame:
        return self.read(name).groupBy(key).agg(*[merge(c).alias(c) for c, merge in measures.items()])

    def marts(self, dims: Tables) -> LazyTables:
        """The six marts out of their states."""

        def daily() -> DataFrame:
            refunds = self._merged("day_refunds", "date_key", _amounts("refund_amount_usd"))
            traffic, turnover = (self.read(n).drop("month") for n in ("day_traffic", "day_turnover"))
            return marts.daily_of(dims["dim_date"], traffic, turnover, refunds)

        def marketing() -> DataFrame:
            visitors = bitmap_counts(self.read("channel_visitors"), ["marketing_key"], "unique_visitors")
            traffic = self._merged("channel_traffic", "marketing_key", _TRAFFIC).join(visitors, "marketing_key", "left")
            return marts.marketing_of(dims["dim_marketing"], traffic, self._merged("channel_sales", "marketing_key", _TURNOVER))

        def products() -> DataFrame:
            sold = self._merged("product_sales", "product_key", _PRODUCTS)
            return marts.product_of(dims["dim_product"], sold.drop("first_refund", "last_refund"))

        def customers() -> DataFrame:
            visits = self._merged("customer_visits", "customer_key", _added("session_count", "repeat_session_count"))
            bought = self._merged("customer_sales", "customer_key", _BOUGHT)
            bought = bought.withColumn("last_order_date", _day_of(F.col("last_day"))).drop("last_day")
            return marts.customer_of(dims["dim_customer"], visits, bought)

        def refunds() -> DataFrame:
            sold = self._merged("product_sales", "product_key", _PRODUCTS)
            # Products without refunds have an amount of 0 and no days: both halves come from one aggregate.
            measures = sold.select(
                "product_key",
                "orders",
                F.col("units_sold").alias("items_sold"),
                "gross_revenue_usd",
                F.col("refunded_items").alias("items_refunded"),
                _day_of(F.col("first_refund")).alias("first_refund_date"),
                _day_of(F.col("last_refund")).alias("last_refund_date"),
                "refund_amount_usd",
            )
            return marts.refunds_of(dims["dim_product"], measures)

        return LazyTables(
            {
                "daily_performance": daily,
                "marketing_performance": marketing,
                "product_performance": products,
                "customer_summary": customers,
                "funnel_performance": lambda: marts.funnel_of(dims["dim_date"], self.read("day_steps").drop("month")),
                "refunds_performance": refunds,
            }
        )
