"""Shop entities derived from the supplied benchmark tables.

``web``    an event stream becomes sessions, pageviews, orders, items and refunds (clean);
``dirty``  the same with faults in every entity, for the rules;
``volume`` orders and their lines become the same six entities, with the repeated keys, orphan
           refunds and sessions without pageviews that those tables really have.

Amounts are computed in whole cents and turned into the sources' floating-point money last.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.functions import labels
from merchlake.plans.lazy import LazyTables, mapped

Tables = Mapping[str, DataFrame]

EPOCH = "2024-01-01"
PRODUCT_SPREAD = 200
PRODUCT_PAGES = labels.FUNNEL_PAGES["product_detail"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _dollars(cents: Column) -> Column:
    return cents.cast("double") / 100.0


def _cost(cents: Column) -> Column:
    return _div(cents * 60, 100)


def _choose(number: Column, values: list[str | None]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number + 1).cast("int"))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.lit(f"{EPOCH} 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.col("p_name").alias("product_name"),
    )


# --- web -----------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.to_date("ts"), F.lit(EPOCH).cast("date"))
    return _table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        _cents("value").alias("cents"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        day.alias("day"),
        (F.col("user_id") * 100_000 + day).alias("website_session_id"),
    )


def _web_pageviews(events: DataFrame) -> DataFrame:
    kind, k = F.col("event_type"), F.col("k")
    url = (
        F.when(kind == "view", "/products")
        .when(kind == "click", _choose(k % 4, PRODUCT_PAGES))
        .when(kind == "signup", "/cart")
        .when(kind == "error", "/shipping")
        .otherwise(_choose(k % 2, ["/billing", "/billing-2"]))
    )
    return events.select(
        F.col("event_id").alias("website_pageview_id"),
        F.col("ts").alias("created_at"),
        "website_session_id",
        url.alias("pageview_url"),
    )


def _web_sessions(events: DataFrame) -> DataFrame:
    visits = events.groupBy("website_session_id", "user_id", "day").agg(
        F.min("ts").alias("created_at"), F.min_by("k", F.struct("ts", "event_id")).alias("k0")
    )
    first_days = events.groupBy("user_id").agg(F.min("day").alias("first_day"))
    k0 = F.col("k0")
    return visits.join(first_days, "user_id").select(
        "website_session_id",
        "created_at",
        "user_id",
        F.when(F.col("day") == F.col("first_day"), 0).otherwise(1).alias("is_repeat_session"),
        _choose(k0 % 4, [" GSearch ", "bsearch", "socialbook", None]).alias("utm_source"),
        _choose(k0 % 3, ["NonBrand", "brand", None]).alias("utm_campaign"),
        _choose(k0 % 4, ["ad_0", "ad_1", "ad_2", None]).alias("utm_content"),
        F.when(k0 % 10 < 7, "desktop").otherwise("mobile").alias("device_type"),
        F.when(k0 % 5 != 0, "https://www.search.example").alias("http_referer"),
    )


def _purchases(events: DataFrame) -> DataFrame:
    count = 1 + F.col("k") % 2
    price = F.col("cents") * count
    return events.filter(F.col("event_type") == "purchase").select(
        "*", count.alias("item_count"), price.alias("order_cents"), _cost(price).alias("order_cost")
    )


def _web_orders(purchases: DataFrame) -> DataFrame:
    return purchases.select(
        F.col("event_id").alias("order_id"),
        F.col("ts").alias("created_at"),
        "website_session_id",
        "user_id",
        ((F.col("event_id") * 7 + 1) % PRODUCT_SPREAD).cast("int").alias("primary_product_id"),
        F.col("item_count").alias("items_purchased"),
        _dollars(F.col("order_cents")).alias("price_usd"),
        _dollars(F.col("order_cost")).alias("cogs_usd"),
    )


def _item_lines(purchases: DataFrame) -> DataFrame:
    """One row per item; the first item carries what rounding left of the order's cost."""
    line = F.col("line")
    lines = purchases.withColumn("line", F.explode(F.sequence(F.lit(1), F.col("item_count"))))
    other = _cost(F.col("cents"))
    first = F.col("order_cost") - (F.col("item_count") - 1) * other
    return lines.select(
        "*",
        (F.col("event_id") * 10 + line).alias("order_item_id"),
        F.when(line == 1, first).otherwise(other).alias("item_cost"),
    )


def _web_items(lines: DataFrame) -> DataFrame:
    product = (F.col("event_id") * 7 + F.col("line")) % PRODUCT_SPREAD
    return lines.select(
        "order_item_id",
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("order_id"),
        product.cast("int").alias("product_id"),
        F.when(F.col("line") == 1, 1).otherwise(0).alias("is_primary_item"),
        _dollars(F.col("cents")).alias("price_usd"),
        _dollars(F.col("item_cost")).alias("cogs_usd"),
    )


def _web_refunds(lines: DataFrame) -> DataFrame:
    """Every 17th price step is refunded after three days, every 34th once more after forty."""
    number = F.explode(F.sequence(F.lit(1), F.when(F.col("k") % 34 == 0, 2).otherwise(1)))
    refunds = lines.filter(F.col("k") % 17 == 0).withColumn("number", number)
    delay = F.when(F.col("number") == 1, F.expr("interval 3 days")).otherwise(
        F.expr("interval 40 days")
    )
    return refunds.select(
        (F.col("order_item_id") * 10 + F.col("number")).alias("order_item_refund_id"),
        (F.col("ts") + delay).alias("created_at"),
        "order_item_id",
        F.col("event_id").alias("order_id"),
        _dollars(_div(F.col("cents"), 2)).alias("refund_amount_usd"),
    )


def web(spark: SparkSession, sf_dir: str) -> Tables:
    bases = LazyTables(
        {
            "events": lambda: _events(spark, sf_dir),
            "purchases": lambda: _purchases(bases["events"]),
            "lines": lambda: _item_lines(bases["purchases"]),
        }
    )
    entities = {
        "website_sessions": lambda: _web_sessions(bases["events"]),
        "website_pageviews": lambda: _web_pageviews(bases["events"]),
        "products": lambda: _products(spark, sf_dir),
        "orders": lambda: _web_orders(bases["purchases"]),
        "order_items": lambda: _web_items(bases["lines"]),
        "order_item_refunds": lambda: _web_refunds(bases["lines"]),
    }
    return mapped(LazyTables(entities), _conformed)


def _conformed(name: str, rows: DataFrame) -> DataFrame:
    return schemas.conform(rows, schemas.SOURCES[name])


# --- dirty ---------------------------------------------------------------------------------

KEYS = {
    "website_sessions": "website_session_id",
    "website_pageviews": "website_pageview_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "order_item_refunds": "order_item_refund_id",
}

# Faults put into otherwise clean rows: column → (every n-th key, SQL value). They replace
# values; all rows stay.
FAULTS = {
    "website_sessions": {
        "user_id": [(19, "NULL")],
        "device_type": [(13, "'tablet'"), (17, "'Desktop'")],
        "utm_source": [(7, "'   '")],
    },
    "website_pageviews": {
        "created_at": [(23, "NULL")],
        "website_session_id": [(19, "NULL")],
        "pageview_url": [(13, "'   '"), (17, "NULL")],
    },
    "products": {
        "created_at": [(23, "NULL")],
        "product_name": [(13, "''"), (17, "NULL"), (7, "'  Boxed item '")],
    },
    "orders": {
        "user_id": [(23, "NULL")],
        "items_purchased": [(19, "0")],
        "price_usd": [(13, "-10.0"), (17, "CAST('NaN' AS DOUBLE)")],
        "cogs_usd": [(29, "NULL")],
    },
    "order_items": {
        "order_id": [(19, "-1")],
        "product_id": [(23, "NULL")],
        "cogs_usd": [(13, "-1.0")],
    },
    "order_item_refunds": {
        "order_item_id": [(7, "-1")],
        "refund_amount_usd": [(13, "-1.0")],
    },
}
# Every n-th row comes again with another value in one column, and every m-th as an exact copy.
REPEATS = {
    "website_sessions": (11, "created_at", "created_at + INTERVAL '1' HOUR"),
    "website_pageviews": (11, "pageview_url", "'/again'"),
    "products": (11, "product_name", "'Again'"),
    "orders": (11, "price_usd", "price_usd + 1.0"),
    "order_items": (11, "price_usd", "price_usd + 1.0"),
    "order_item_refunds": (3, "refund_amount_usd", "refund_amount_usd + 1.0"),
}
COPY_EVERY, UNKEYED_EVERY = 9, 29


def _with_faults(name: str, clean: DataFrame) -> DataFrame:
    key = KEYS[name]
    every, column, changed = REPEATS[name]
    repeated = clean.filter(F.col(key) % every == 0).withColumn(column, F.expr(changed))
    copied = clean.filter(F.col(key) % COPY_EVERY == 0)
    unkeyed = clean.filter(F.col(key) % UNKEYED_EVERY == 0).withColumn(key, F.lit(None))
    faulty = clean
    for target, faults in FAULTS[name].items():
        value = F.col(target)
        for step, bad in faults:
            value = F.when(F.col(key) % step == 0, F.expr(bad)).otherwise(value)
        faulty = faulty.withColumn(target, value)
    rows = faulty.unionByName(repeated).unionByName(copied).unionByName(unkeyed)
    return schemas.conform(rows, schemas.SOURCES[name])


def dirty(spark: SparkSession, sf_dir: str) -> Tables:
    return mapped(web(spark, sf_dir), _with_faults)


# --- volume --------------------------------------------------------------------------------


def _volume_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").withColumns(
        {
            "cents": _cents("l_extendedprice"),
            "line_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        }
    )


def _volume_sessions(orders: DataFrame) -> DataFrame:
    priority, number = F.col("o_orderpriority"), F.col("o_orderkey")
    marked = priority != "5-LOW"
    return orders.select(
        number.alias("website_session_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_custkey").alias("user_id"),
        (number % 2).alias("is_repeat_session"),
        F.when(marked, priority).alias("utm_source"),
        F.when(marked, F.col("o_orderstatus")).alias("utm_campaign"),
        F.when(marked & (number % 3 == 0), "ad_x").alias("utm_content"),
        F.when(number % 4 == 0, "mobile").otherwise("desktop").alias("device_type"),
        F.when(number % 5 != 0, "https://www.search.example").alias("http_referer"),
    )


def _volume_pageviews(lines: DataFrame) -> DataFrame:
    pages = ["/products", PRODUCT_PAGES[0], "/cart", "/shipping", "/billing", "/home"]
    return lines.select(
        F.col("line_id").alias("website_pageview_id"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_orderkey").alias("website_session_id"),
        _choose(F.col("l_linenumber") % 6, pages).alias("pageview_url"),
    )


def _volume_orders(orders: DataFrame) -> DataFrame:
    number, cents = F.col("o_orderkey"), _cents("o_totalprice")
    return orders.select(
        number.alias("order_id"),
        F.col("o_orderdate").alias("created_at"),
        number.alias("website_session_id"),
        F.col("o_custkey").alias("user_id"),
        (number % PRODUCT_SPREAD).alias("primary_product_id"),
        (1 + number % 3).alias("items_purchased"),
        _dollars(cents).alias("price_usd"),
        _dollars(_cost(cents)).alias("cogs_usd"),
    )


def _volume_items(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("line_id").alias("order_item_id"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_linenumber") == 1, 1).otherwise(0).alias("is_primary_item"),
        _dollars(F.col("cents")).alias("price_usd"),
        _dollars(_cost(F.col("cents"))).alias("cogs_usd"),
    )


def _volume_refunds(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("l_returnflag") == "R").select(
        F.col("line_id").alias("order_item_refund_id"),
        (F.col("l_shipdate") + F.expr("interval 30 days")).alias("created_at"),
        F.col("line_id").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        _dollars(_div(F.col("cents"), 2)).alias("refund_amount_usd"),
    )


def volume(spark: SparkSession, sf_dir: str) -> Tables:
    entities = {
        "website_sessions": lambda: _volume_sessions(_table(spark, sf_dir, "orders")),
        "website_pageviews": lambda: _volume_pageviews(_volume_lines(spark, sf_dir)),
        "products": lambda: _products(spark, sf_dir),
        "orders": lambda: _volume_orders(_table(spark, sf_dir, "orders")),
        "order_items": lambda: _volume_items(_volume_lines(spark, sf_dir)),
        "order_item_refunds": lambda: _volume_refunds(_volume_lines(spark, sf_dir)),
    }
    return mapped(LazyTables(entities), _conformed)
