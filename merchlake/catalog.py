"""Registry of runnable queries over the supplied tables.

Each entry takes (session, table folder) and returns a lazy DataFrame over whole tables. Results
use plain types: whole numbers as bigint, amounts and rates as double, days as ISO text.
Surrogate keys are left out where only the business key is meaningful.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import cached_property, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DecimalType, IntegerType, ShortType

from merchlake.functions import dates, labels
from merchlake.operators import (
    increments,
    keyset,
    quality,
    quarantine,
    rules,
    runlog,
    split,
    surrogate,
    tables,
    transforms,
    upsert,
    validators,
    watermarks,
)
from merchlake.operators.constraints import ForeignKey, guard
from merchlake.operators.increments import OrderStore
from merchlake.operators.keyset import Watermark
from merchlake.plans import analyses, dimensions, facts, mart_states, reconciliation, staging
from merchlake.plans.lazy import mapped, side_by_side
from merchlake.plans.monthly_facts import FLAGS, MonthlyFacts, Refresh
from merchlake.plans.shop import open_shop, written
from merchlake.session import configure, work_folder
from merchlake.sources import files, supplied
from merchlake.streaming import orders as order_stream
from merchlake.streaming import pageviews as pageview_stream

Tables = Mapping[str, DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

# Positions and dates that individual queries ask for.
KEYSET_POSITION = Watermark(datetime(2024, 1, 15, 12, 0, 0), 5000)
LOOKUP_ORDER = 7
PAGE_OFFSET, PAGE_LIMIT = 500, 1000
FIRST_RUN_UNTIL = "2024-01-16 00:00:00"
UPSERT_TARGET_UNTIL, UPSERT_SOURCE_FROM = "2024-01-20 00:00:00", "2024-01-10 00:00:00"
KNOWN_CUSTOMERS_UNTIL = "1996-01-01 00:00:00"
REJECTED_AT = datetime(2024, 1, 1)
FIRST_BUILD_UNTIL = "1997-03-10 00:00:00"
FACT_ROWS = {"fact_sales": ("order_item_id", "sales_key"), "fact_sessions": ("website_session_id", "session_key")}
# Dimensions that a fact is made of or checked against.
DIMS_OF = {
    "fact_sales": ["dim_date", "dim_product", "dim_customer"],
    "fact_sessions": ["dim_date", "dim_customer", "dim_marketing", "dim_device"],
}
EXPORT_ROWS, CHUNK_ROWS, REPEATED_AFTER = 4000, 500, 150
RUN_ID = "run-1"

QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    def shown(field):
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, ByteType | ShortType | IntegerType):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, DateType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[shown(field) for field in df.schema.fields])


def register(name: str, *hidden: str):
    """Adds a query; ``hidden`` columns (surrogate keys, helpers) are dropped."""

    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(configure(spark), sf_dir).drop(*hidden))

        QUERIES[name] = run
        return build

    return add


def web_staged(spark: SparkSession, sf_dir: str) -> Tables:
    """The clean entities; no rule rejects a row of them (see ``validation_counts_clean``)."""
    return staging.transform_all(supplied.web(spark, sf_dir))


# --- sources, keyset and order service -----------------------------------------------------


@register("orders_sorted")
def _(spark, sf_dir):
    return files.sort_orders(supplied.web(spark, sf_dir)["orders"])


@register("orders_page")
def _(spark, sf_dir):
    orders = supplied.web(spark, sf_dir)["orders"]
    total = orders.agg(F.count("*")).scalar()
    return files.order_page(orders, PAGE_LIMIT, PAGE_OFFSET).withColumn("total", total)


@register("orders_keyset_increment")
def _(spark, sf_dir):
    return keyset.after(supplied.web(spark, sf_dir)["orders"], KEYSET_POSITION)


@register("order_lookup")
def _(spark, sf_dir):
    return files.order_by_id(supplied.web(spark, sf_dir)["orders"], LOOKUP_ORDER)


@register("orders_iso_dates")
def _(spark, sf_dir):
    orders = supplied.web(spark, sf_dir)["orders"]
    return orders.select("order_id", dates.iso_text(F.col("created_at")).alias("created_at"))


@register("orders_checkpoint")
def _(spark, sf_dir):
    return keyset.checkpoint(supplied.web(spark, sf_dir)["orders"])


# --- files, tables and streams: written out of the supplied data, read back ------------------


def _folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/round-trip-{uuid4().hex}/{name}"


def _as_export(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """CSV export with its columns in another order, one column more, and quoted texts."""
    path = _folder(spark, name)
    texts = [F.col(c).cast("string").alias(c) for c in reversed(rows.columns)]
    shuffled = rows.select(F.lit("line\nbreak").alias("note"), *texts)
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    shuffled.write.options(header=True, quoteAll=True, escape='"', **spaces).csv(path)
    return path


@register("source_sessions_csv")
def _(spark, sf_dir):
    rows = supplied.web(spark, sf_dir)["website_sessions"]
    return files.read_sessions(spark, _as_export(spark, rows, "sessions"))


@register("source_pageviews_csv")
def _(spark, sf_dir):
    rows = supplied.web(spark, sf_dir)["website_pageviews"]
    return files.read_pageviews(spark, _as_export(spark, rows, "pageviews"), multi_line=True)


def _land_documents(spark: SparkSession, rows: DataFrame, key: str, name: str, document) -> str:
    """JSON files of at most about a thousand rows each."""
    path = _folder(spark, name)
    paged = rows.withColumn("page", F.floor(F.col(key) / 1000).cast("long"))
    text = document(F.collect_list(F.struct(*rows.columns))).alias("value")
    paged.groupBy("page").agg(text).repartition("page").write.partitionBy("page").text(path)
    return path


@register("source_products_json")
def _(spark, sf_dir):
    rows = supplied.web(spark, sf_dir)["products"]
    path = _land_documents(spark, rows, "product_id", "products", F.to_json)
    return files.read_products(spark, path).drop("page")


def _land_order_pages(spark: SparkSession, orders: DataFrame) -> str:
    def page(rows):
        total = F.size(rows).cast("long")
        fields = [total.alias("total"), total.alias("limit"), F.lit(0).cast("long").alias("offset")]
        return F.to_json(F.struct(*fields, rows.alias("orders")))

    texts = orders.withColumn("created_at", dates.iso_text(F.col("created_at")))
    return _land_documents(spark, texts, "order_id", "order-pages", page)


@register("source_order_pages")
def _(spark, sf_dir):
    orders = supplied.web(spark, sf_dir)["orders"]
    return files.read_order_pages(spark, _land_order_pages(spark, orders))


@register("order_store_runs", "gross_profit")
def _(spark, sf_dir):
    """Two runs, a compaction between a micro-batch and its replay, and the merged state."""
    orders = web_staged(spark, sf_dir)["orders"]
    store = OrderStore(_folder(spark, "store"))
    until, since = (F.lit(x).cast("timestamp_ntz") for x in (UPSERT_TARGET_UNTIL, UPSERT_SOURCE_FROM))
    first = orders.filter(F.col("created_at") < until)
    store.append(first, "batches", 0)
    store.append(orders.filter(F.col("created_at") >= since).withColumn("price_usd", F.col("price_usd") + 1.0))
    store.compact(spark)
    store.append(first, "batches", 0)
    return store.read(spark)


@register("order_stream_state", "gross_profit")
def _(spark, sf_dir):
    """Landed pages taken over by the stream in micro-batches."""
    folder = _folder(spark, "stream")
    pages = _land_order_pages(spark, supplied.web(spark, sf_dir)["orders"])
    store = OrderStore(f"{folder}/store")
    order_stream.stream_orders(spark, pages, store, f"{folder}/rejected", f"{folder}/checkpoint").awaitTermination()
    return store.read(spark)


@register("pageview_stream_state")
def _(spark, sf_dir):
    folder = _folder(spark, "pageviews")
    rows = supplied.web(spark, sf_dir)["website_pageviews"]
    texts = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    texts.repartition(4).write.option("header", True).csv(f"{folder}/exports")
    pageview_stream.stream_pageviews(
        spark, f"{folder}/exports", f"{folder}/staged", f"{folder}/rejected", f"{folder}/checkpoint", 2
    ).awaitTermination()
    return pageview_stream.staged_pageviews(spark, f"{folder}/staged")


@register("pageview_chunks")
def _(spark, sf_dir):
    """Exports of several files, each staged in chunks of rows: an id may come once per chunk."""
    folder = _folder(spark, "chunks")
    clean = supplied.web(spark, sf_dir)["website_pageviews"]
    place = 2 * F.col("website_pageview_id")
    again = clean.filter(F.col("website_pageview_id") % 3 == 0).withColumns(
        {"pageview_url": F.lit("/again"), "place": place + 2 * REPEATED_AFTER + 1}
    )
    rows = clean.withColumn("place", place).unionByName(again).withColumn("number", F.floor(F.col("place") / EXPORT_ROWS))
    texts = [F.col(c).cast("string").alias(c) for c in clean.columns]
    in_order = rows.repartition("number").sortWithinPartitions("number", "place")
    in_order.select("number", F.lit("line\nbreak").alias("note"), *texts).write.partitionBy("number").options(
        header=True, quoteAll=True, escape='"'
    ).csv(f"{folder}/exports")
    pageview_stream.load_chunks(
        spark, f"{folder}/exports", f"{folder}/staged", f"{folder}/rejected", RUN_ID, CHUNK_ROWS
    )
    staged = spark.read.parquet(f"{folder}/staged")
    return staged.select("website_pageview_id", "website_session_id", "pageview_url", "chunk", "row")


@register("sink_replace_append")
def _(spark, sf_dir):
    """Replaced twice, then extended once: every row twice."""
    products = supplied.web(spark, sf_dir)["products"]
    path = _folder(spark, "products")
    tables.ensure(spark, path, products.schema)
    for mode in ("replace", "replace", "append"):
        tables.load(products, path, mode)
    return spark.read.schema(products.schema).parquet(path)


# --- transforms and rules ------------------------------------------------------------------


def _register_entity(entity: str, short: str) -> None:
    @register(f"transform_{short}")
    def _(spark, sf_dir):
        return transforms.TRANSFORMS[entity](supplied.dirty(spark, sf_dir)[entity])

    @register(f"validate_{short}")
    def _(spark, sf_dir):
        parts = open_shop(spark, sf_dir, "dirty").split(entity)
        valid = parts.valid.withColumn("is_valid", F.lit(True))
        return valid.unionByName(parts.rejected.withColumn("is_valid", F.lit(False)))


for _entity, _short in {
    "website_sessions": "sessions",
    "website_pageviews": "pageviews",
    "products": "products",
    "orders": "orders",
    "order_items": "order_items",
    "order_item_refunds": "refunds",
}.items():
    _register_entity(_entity, _short)


@register("rule_is_unique")
def _(spark, sf_dir):
    orders = supplied.dirty(spark, sf_dir)["orders"]
    flagged = split.flag_first(orders, "order_id", "is_first")
    return flagged.select("order_id", "created_at", "price_usd", "is_first")


@register("rule_not_empty_string")
def _(spark, sf_dir):
    pageviews = supplied.dirty(spark, sf_dir)["website_pageviews"]
    passed = rules.not_empty_string("pageview_url").alias("passed")
    return pageviews.select("website_pageview_id", "pageview_url", passed)


def _register_counts(suffix: str, entity_set: str) -> None:
    @register(f"validation_counts{suffix}")
    def _(spark, sf_dir):
        shop = open_shop(spark, sf_dir, entity_set)
        parts = [
            shop.split(name).counts.select(F.lit(name).alias("source_name"), "*")
            for name in shop.raw
        ]
        return reduce(DataFrame.unionByName, parts)


_register_counts("", "dirty")
_register_counts("_clean", "web")
_register_counts("_volume", "volume")


@register("quarantine_rows")
def _(spark, sf_dir):
    rejected = validators.validate_orders(supplied.dirty(spark, sf_dir)["orders"]).rejected
    return quarantine.mark_rejected(rejected, RUN_ID, REJECTED_AT)


@register("order_items_semi")
def _(spark, sf_dir):
    raw = supplied.dirty(spark, sf_dir)
    return quality.referenced(raw["order_items"], "order_id", raw["orders"], "order_id")


@register("orders_anti_orphans")
def _(spark, sf_dir):
    """Orders without any order line."""
    raw = supplied.volume(spark, sf_dir)
    return quality.orphans(raw["orders"], "order_id", raw["order_items"], "order_id")


# --- table states, keys, checkpoints -------------------------------------------------------


@register("orders_upsert")
def _(spark, sf_dir):
    orders = web_staged(spark, sf_dir)["orders"]
    target = orders.filter(F.col("created_at") < F.lit(UPSERT_TARGET_UNTIL).cast("timestamp_ntz"))
    changed = orders.filter(
        F.col("created_at") >= F.lit(UPSERT_SOURCE_FROM).cast("timestamp_ntz")
    ).withColumn("price_usd", F.col("price_usd") + 1.0)
    return upsert.upsert(target, changed, ["order_id"]).drop("gross_profit")


def _volume_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = supplied.volume(spark, sf_dir)
    limit = F.lit(KNOWN_CUSTOMERS_UNTIL).cast("timestamp_ntz")
    known = {n: raw[n].filter(F.col("created_at") < limit) for n in ("website_sessions", "orders")}
    before = dimensions.customer_members(known["website_sessions"], known["orders"])
    return before, dimensions.customer_members(raw["website_sessions"], raw["orders"])


@register("surrogate_keys")
def _(spark, sf_dir):
    _, members = _volume_customers(spark, sf_dir)
    return surrogate.assign(members, ["user_id"], "customer_key").select("user_id", "customer_key")


@register("dim_upsert_preserves_keys")
def _(spark, sf_dir):
    before, after = _volume_customers(spark, sf_dir)
    target = dimensions.numbered("dim_customer", before)
    return upsert.upsert(target, after, ["user_id"], "customer_key")


@register("incremental_orders_two_runs")
def _(spark, sf_dir):
    """A first load up to a date, then everything behind its checkpoint."""
    source = supplied.dirty(spark, sf_dir)["orders"]
    until = F.lit(FIRST_RUN_UNTIL).cast("timestamp_ntz")
    first = _taken_over(source.filter(F.col("created_at") < until))
    position = Watermark(*keyset.checkpoint(first).first())
    second = _taken_over(keyset.after(source, position)).withColumn("run", F.lit(1))
    return increments.merge(first, second).drop("gross_profit")


def _taken_over(orders: DataFrame) -> DataFrame:
    return transforms.transform_orders(validators.validate_orders(orders).valid)


@register("late_orders")
def _(spark, sf_dir):
    """Orders at or before the checkpoint that no later increment will read."""
    source = supplied.dirty(spark, sf_dir)["orders"]
    staged = _taken_over(source)
    position = Watermark(*keyset.checkpoint(staged).first())
    return keyset.late(source, staged, position)


@register("watermark_upsert")
def _(spark, sf_dir):
    """Checkpoints per order priority: one from the early orders, then from all orders."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")

    def positions(rows: DataFrame) -> DataFrame:
        top = F.max(F.struct("o_orderdate", "o_orderkey")).alias("top")
        return rows.groupBy("o_orderpriority").agg(top).select(
            F.lit(runlog.PIPELINE_NAME).alias("pipeline_name"),
            F.col("o_orderpriority").alias("source_name"),
            F.col("top.o_orderdate").alias("last_created_at"),
            F.col("top.o_orderkey").alias("last_id"),
        )

    early = F.col("o_orderdate") < F.lit(KNOWN_CUSTOMERS_UNTIL).cast("timestamp_ntz")
    return watermarks.set_watermarks(
        positions(orders.filter(early)), positions(orders)
    )


# --- star schema ---------------------------------------------------------------------------


@register("staging_date_range")
def _(spark, sf_dir):
    return dimensions.staging_date_range(web_staged(spark, sf_dir))


@register("dim_date")
def _(spark, sf_dir):
    return dimensions.build_dim_date_from_staging(web_staged(spark, sf_dir))


@register("dim_product")
def _(spark, sf_dir):
    return dimensions.product_members(web_staged(spark, sf_dir)["products"])


@register("dim_customer")
def _(spark, sf_dir):
    staged = web_staged(spark, sf_dir)
    return dimensions.customer_members(staged["website_sessions"], staged["orders"])


@register("dim_customer_without_session")
def _(spark, sf_dir):
    """Visitors of one shop joined with buyers of another, who have no sessions."""
    visits = web_staged(spark, sf_dir)["website_sessions"]
    return dimensions.customer_members(visits, supplied.volume(spark, sf_dir)["orders"])


@register("dim_marketing")
def _(spark, sf_dir):
    return dimensions.marketing_members(web_staged(spark, sf_dir)["website_sessions"])


@register("dim_marketing_dirty")
def _(spark, sf_dir):
    sessions = validators.validate_sessions(supplied.dirty(spark, sf_dir)["website_sessions"])
    return dimensions.marketing_members(transforms.transform_sessions(sessions.valid))


@register("dim_device")
def _(spark, sf_dir):
    return dimensions.device_members(web_staged(spark, sf_dir)["website_sessions"])


@register("pageviews_by_session")
def _(spark, sf_dir):
    return facts.pageviews_by_session(web_staged(spark, sf_dir)["website_pageviews"])


@register("page_steps_by_session")
def _(spark, sf_dir):
    return facts.page_steps_by_session(web_staged(spark, sf_dir)["website_pageviews"])


@register("orders_by_session")
def _(spark, sf_dir):
    return facts.orders_by_session(web_staged(spark, sf_dir)["orders"])


@register("refunds_by_item")
def _(spark, sf_dir):
    refunds = web_staged(spark, sf_dir)["order_item_refunds"]
    return facts.refunds_by_item(refunds).drop("is_refunded")


def _register_star(suffix: str, entity_set: str) -> None:
    """Facts, gate and marts of one shop."""

    @register(f"fact_sales{suffix}", "product_key", "customer_key")
    def _(spark, sf_dir):
        tables = open_shop(spark, sf_dir, entity_set).warehouse
        products = tables["dim_product"].select("product_key", "product_id")
        customers = tables["dim_customer"].select("customer_key", "user_id")
        return tables["fact_sales"].join(products, "product_key").join(customers, "customer_key")

    @register(f"fact_sessions{suffix}", "customer_key", "marketing_key", "device_key", "is_direct")
    def _(spark, sf_dir):
        tables = open_shop(spark, sf_dir, entity_set).warehouse
        customers = tables["dim_customer"].select("customer_key", "user_id")
        devices = tables["dim_device"].select("device_key", "device_type")
        return (
            tables["fact_sessions"]
            .join(customers, "customer_key")
            .join(devices, "device_key")
            .join(tables["dim_marketing"], "marketing_key")
        )

    @register(f"reconciliation{suffix}")
    def _(spark, sf_dir):
        shop = open_shop(spark, sf_dir, entity_set)
        return reconciliation.reconcile(shop.staged, shop.facts)

    def add_mart(mart: str, *hidden: str) -> None:
        @register(f"{mart}{suffix}", *hidden)
        def _(spark, sf_dir):
            return open_shop(spark, sf_dir, entity_set).marts[mart]

    add_mart("daily_performance")
    add_mart("marketing_performance", "marketing_key")
    add_mart("product_performance", "product_key")
    add_mart("customer_summary", "customer_key")
    add_mart("funnel_performance")
    add_mart("refunds_performance", "product_key")


_register_star("", "web")
_register_star("_volume", "volume")


class _TwoRuns:
    """Monthly facts and mart states of one shop: a run until a date, then one over everything.

    A fact or state is written by both runs once a query asks for it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._shop = shop = open_shop(spark, sf_dir, "volume")
        until = F.lit(FIRST_BUILD_UNTIL).cast("timestamp_ntz")

        def early(name: str, rows: DataFrame) -> DataFrame:
            return rows if name == "products" else rows.filter(F.col("created_at") < until)

        self._staged = [mapped(shop.staged, early), shop.staged]
        # Several steps of a run read the paths, so both runs' are written.
        self._digests = [written(facts.build_digests(self._staged[0]), _folder(spark, "early")), shop.digests]
        self.facts, self.dims = MonthlyFacts(spark, _folder(spark, "monthly")), shop.dims
        self.states, self._done = mart_states.MartStates(spark, self.facts), set()

    @cached_property
    def sales(self) -> list[Refresh]:
        return [self.facts.refresh_sales(staged, self.dims) for staged in self._staged]

    @cached_property
    def sessions(self) -> list[Refresh]:
        both = zip(self._staged, self._digests, strict=True)
        return [self.facts.refresh_sessions(staged, self.dims, d["session_visits"]) for staged, d in both]

    def need(self, *names: str) -> None:
        """Both runs of these facts and what they are made of; what does not depend on each other side by side."""
        for layer in staging.STAGING_LAYERS:
            side_by_side(self._shop.staged.__getitem__, layer)
        made_of = {d for n in names for d in DIMS_OF[n]}
        side_by_side(self.dims.__getitem__, sorted(made_of))
        side_by_side(self.fact, names)

    def fact(self, name: str) -> list[Refresh]:
        return {"fact_sales": lambda: self.sales, "fact_sessions": lambda: self.sessions}[name]()

    def read(self, name: str, run: int = 1) -> DataFrame:
        """A fact after the first (0) or second run."""
        self.need(name)
        return self.facts.read(name, run=self.fact(name)[run].run)

    def mart(self, name: str) -> DataFrame:
        names = set(mart_states.STATES_OF[name]) - self._done
        made_of = {"fact_sales": names - mart_states.OF_SESSIONS, "fact_sessions": names - mart_states.OF_SALES}
        self.need(*[n for n, states in made_of.items() if states])
        sales, sessions = (self.fact(n) if states else [None, None] for n, states in made_of.items())
        for run in range(2):
            steps = self._digests[run]["session_visits"] if "day_steps" in names else None
            self.states.refresh(sales[run], sessions[run], steps, names)
        self._done |= names
        return self.states.marts(self.dims)[name]


_TWICE: dict[tuple[str, str], _TwoRuns] = {}


def _two_runs(spark: SparkSession, sf_dir: str) -> _TwoRuns:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TWICE:
        _TWICE[key] = _TwoRuns(spark, sf_dir)
    return _TWICE[key]


@register("fact_sales_two_builds", "product_key", "customer_key", "sales_key", "month", *FLAGS)
def _(spark, sf_dir):
    runs = _two_runs(spark, sf_dir)
    products = runs.dims["dim_product"].select("product_key", "product_id")
    customers = runs.dims["dim_customer"].select("customer_key", "user_id")
    return runs.read("fact_sales").join(products, "product_key").join(customers, "customer_key")


@register("fact_sessions_two_builds", "customer_key", "marketing_key", "device_key", "is_direct", "session_key", "month")
def _(spark, sf_dir):
    runs = _two_runs(spark, sf_dir)
    return (
        runs.read("fact_sessions")
        .join(runs.dims["dim_customer"].select("customer_key", "user_id"), "customer_key")
        .join(runs.dims["dim_device"].select("device_key", "device_type"), "device_key")
        .join(runs.dims["dim_marketing"], "marketing_key")
    )


@register("fact_keys_two_builds")
def _(spark, sf_dir):
    """Row keys after the second run: without gaps, and how many rows have the key of the first run."""
    runs = _two_runs(spark, sf_dir)
    runs.need(*FACT_ROWS)
    parts = []
    for name, (business, key) in FACT_ROWS.items():
        first = runs.read(name, 0).select(business, F.col(key).alias("first_key"))
        both = runs.read(name).join(first, business, "left")
        measures = [
            F.count("*").alias("n_rows"),
            F.count_distinct(key).alias("n_keys"),
            F.min(key).alias("least"),
            F.max(key).alias("greatest"),
            F.count_if(F.col("first_key") == F.col(key)).alias("n_kept"),
        ]
        parts.append(both.agg(*measures).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


@register("fact_months_two_builds")
def _(spark, sf_dir):
    """Per fact and month its rows, and whether the second run has written it."""
    runs = _two_runs(spark, sf_dir)
    runs.need(*FACT_ROWS)
    found = [
        (name, month, m.rows, m.run == 2)
        for name in FACT_ROWS
        for month, m in runs.facts.table(name).months(spark, runs.fact(name)[1].run).items()
    ]
    return spark.createDataFrame(found, "table_name string, month int, n_rows long, second_run boolean")


def _register_marts_two_builds(mart: str, *hidden: str) -> None:
    @register(f"{mart}_two_builds", *hidden)
    def _(spark, sf_dir):
        return _two_runs(spark, sf_dir).mart(mart)


_register_marts_two_builds("daily_performance")
_register_marts_two_builds("marketing_performance", "marketing_key")
_register_marts_two_builds("product_performance", "product_key")
_register_marts_two_builds("customer_summary", "customer_key")
_register_marts_two_builds("funnel_performance")
_register_marts_two_builds("refunds_performance", "product_key")


@register("distinct_counts_by_bitmap")
def _(spark, sf_dir):
    """Visitors per day, month and channel out of one table of bitmaps, and orders per day and month out of another."""
    shop = open_shop(spark, sf_dir, "web")
    month = F.floor(F.col("date_key") / 100).cast("int")
    seen = shop.facts["fact_sessions"].withColumn("month", month)
    sold = shop.facts["fact_sales"].withColumn("month", month)
    folder = _folder(spark, "bitmaps")
    mart_states.bitmaps(seen, ["marketing_key", "date_key", "month"], "customer_key").write.parquet(f"{folder}/visitors")
    mart_states.bitmaps(sold, ["date_key", "month"], "order_id").write.parquet(f"{folder}/orders")
    visitors, orders = (spark.read.parquet(f"{folder}/{n}") for n in ("visitors", "orders"))
    channels = shop.dims["dim_marketing"].withColumn("channel", F.concat_ws("/", *labels.MARKETING_ATTRIBUTES))
    named = visitors.join(channels.select("marketing_key", "channel"), "marketing_key")

    def counted(parts: DataFrame, measure: str, grain: str) -> DataFrame:
        found = mart_states.bitmap_counts(parts, [grain], "n")
        return found.select(F.lit(measure).alias("measure"), F.lit(grain).alias("grain"), F.col(grain).cast("string").alias("member"), "n")

    parts = [counted(visitors, "visitors", g) for g in ("date_key", "month")]
    parts.append(counted(named, "visitors", "channel"))
    parts += [counted(orders, "orders", g) for g in ("date_key", "month")]
    return reduce(DataFrame.unionByName, parts)


@register("session_visits_in_parts")
def _(spark, sf_dir):
    """Page paths of sessions out of the states of three chunks, each read once."""
    pageviews = web_staged(spark, sf_dir)["website_pageviews"]
    folder = _folder(spark, "visits")
    for part in range(3):
        chunk = pageviews.filter(F.col("website_pageview_id") % 3 == part)
        pageview_stream.add_visit_states(chunk, folder, f"chunk-{part}")
    return pageview_stream.visits(spark, folder)


@register("constraints_at_write")
def _(spark, sf_dir):
    """Rows per constraint of the dirty items that break it, as counted by the write."""
    raw = supplied.dirty(spark, sf_dir)
    items = raw["order_items"]
    products = raw["products"].select("product_id").dropna().distinct()
    orders = raw["orders"].select("order_id").dropna().distinct()
    keys = [ForeignKey("order_id", orders, "order_id"), ForeignKey("product_id", products, "product_id")]
    guarded = guard(items, "order_items", ["order_item_id", "product_id", "cogs_usd"], keys)
    guarded.rows.write.parquet(_folder(spark, "items"))
    names = ["NULL in order_item_id", "NULL in product_id", "NULL in cogs_usd", "unknown order_id", "unknown product_id"]
    found = [(name, guarded.seen.get[f"broken_{k}"]) for k, name in enumerate(names)]
    return spark.createDataFrame(found, "broken string, n_rows long")


@register("warehouse_volumes")
def _(spark, sf_dir):
    """Rows of every warehouse table and mart."""
    shop = open_shop(spark, sf_dir, "web")
    parts = [
        rows.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, rows in (shop.warehouse | shop.marts).items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- analyses ------------------------------------------------------------------------------


def _register_analyses(suffix: str, entity_set: str) -> None:
    def results(spark: SparkSession, sf_dir: str) -> Tables:
        return open_shop(spark, sf_dir, entity_set).analyses

    def add(name: str, of_results: Callable[[Tables], DataFrame]) -> None:
        @register(f"{name}{suffix}")
        def _(spark, sf_dir):
            return of_results(results(spark, sf_dir))

    add("analysis_sales_monthly", lambda r: r["sales_monthly"])
    add("analysis_customer_segments", lambda r: r["customer_segments"])
    add("analysis_marketing_channels", lambda r: r["marketing_channels"])
    add("analysis_funnel_overall", lambda r: r["funnel_overall"])
    add("analysis_products", lambda r: r["product_performance"])
    add("channel_labels", lambda r: analyses.channel_labels(r["marketing_channels"]))
    add("top_month", lambda r: analyses.top_month(r["sales_monthly"]))
    add("top_channel", lambda r: analyses.top_channel(r["marketing_channels"]))
    add("top_product", lambda r: analyses.top_product(r["product_performance"]))
    add("headline_metrics", analyses.headline_metrics)


_register_analyses("", "web")
_register_analyses("_volume", "volume")


# --- constraints and run log ---------------------------------------------------------------


@register("dq_unique")
def _(spark, sf_dir):
    return quality.duplicate_keys(supplied.volume(spark, sf_dir)["order_items"], ["order_item_id"])


@register("dq_not_null")
def _(spark, sf_dir):
    return quality.null_counts(supplied.dirty(spark, sf_dir)["website_pageviews"])


@register("dq_foreign_key")
def _(spark, sf_dir):
    raw = supplied.dirty(spark, sf_dir)
    items, orders, products = raw["order_items"], raw["orders"], raw["products"]
    return quality.foreign_key_report(
        [
            ("order_items_orders", items, "order_id", orders, "order_id"),
            ("order_items_products", items, "product_id", products, "product_id"),
            ("refunds_items", raw["order_item_refunds"], "order_item_id", items, "order_item_id"),
            ("orders_sessions", orders, "website_session_id",
             raw["website_sessions"], "website_session_id"),
        ]
    )


def _run_logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Run and step logs with the shape of a day's visit per user: each event is a step."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    failed = F.col("event_type") == "error"
    status = F.when(failed, runlog.FAILED).otherwise(runlog.SUCCESS)
    run = F.concat_ws("-", "user_id", F.to_date("ts"))
    steps = events.select(
        run.alias("run_id"),
        F.col("event_id").alias("step_run_id"),
        F.col("event_type").alias("step_name"),
        "ts",
        status.alias("final"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.col("value").cast("decimal(12,3)").alias("seconds"),
    )
    entries = F.array(
        F.struct(
            F.lit(runlog.STARTED).alias("status"),
            F.col("ts").alias("logged_at"),
            F.lit(None).cast("decimal(12,3)").alias("duration_seconds"),
            F.lit(0).cast("bigint").alias("rows_processed"),
            F.lit(None).cast("string").alias("error_message"),
        ),
        F.struct(
            F.col("final").alias("status"),
            (F.col("ts") + F.expr("interval 1 second")).alias("logged_at"),
            F.col("seconds").alias("duration_seconds"),
            F.col("k").alias("rows_processed"),
            F.when(F.col("final") == runlog.FAILED, "step failed").alias("error_message"),
        ),
    )
    step_log = steps.select("run_id", "step_run_id", "step_name", F.inline(entries))
    runs = steps.groupBy("run_id").agg(
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
        F.count("*").alias("extracted"),
        F.count_if(F.col("final") == runlog.SUCCESS).alias("loaded"),
        F.count_if(F.col("final") == runlog.FAILED).alias("rejected"),
    )
    bad = F.col("rejected") > 0
    run_entries = F.array(
        F.struct(
            F.lit(runlog.STARTED).alias("status"),
            F.col("first").alias("logged_at"),
            *[F.lit(0).cast("bigint").alias(f"rows_{c}") for c in _COUNTERS],
            F.lit(None).cast("string").alias("error_message"),
        ),
        F.struct(
            F.when(bad, runlog.FAILED).otherwise(runlog.SUCCESS).alias("status"),
            F.col("last").alias("logged_at"),
            *[F.col(c).alias(f"rows_{c}") for c in _COUNTERS],
            F.when(bad, "a step failed").alias("error_message"),
        ),
    )
    run_log = runs.select(
        "run_id", F.lit(runlog.PIPELINE_NAME).alias("pipeline_name"), F.inline(run_entries)
    )
    return run_log, step_log


_COUNTERS = ["extracted", "loaded", "rejected"]


@register("run_states")
def _(spark, sf_dir):
    return runlog.current_runs(_run_logs(spark, sf_dir)[0])


@register("latest_run")
def _(spark, sf_dir):
    return runlog.latest_run(_run_logs(spark, sf_dir)[0])


@register("run_steps")
def _(spark, sf_dir):
    """Step states of all runs."""
    return runlog.current_steps(_run_logs(spark, sf_dir)[1])
