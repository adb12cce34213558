"""The two fact tables kept by month: a run rewrites only months in which some input has changed.

Each run keeps a fingerprint per row of what a fact is made of: items, orders and refund totals of
fact_sales; sessions, page digests and order totals of fact_sessions. The next run compares keys and
fingerprints, not rows; what differs names the months to build again. A fact row keeps its surrogate
key for good, and rows whose source is gone stay, as in an upsert.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from merchlake.functions import dates
from merchlake.operators import surrogate
from merchlake.operators.constraints import ConstraintError, ForeignKey, guard
from merchlake.operators.monthly import MonthlyTable, month_of
from merchlake.operators.tables import delete_folder, finished_numbers
from merchlake.plans import facts

Tables = Mapping[str, DataFrame]
Build = Callable[[DataFrame], DataFrame]

# The columns of a fact that may be NULL.
OPTIONAL = {"refund_date_key"}
#: Whether a row is the first item of its order, and of its order and product: orders are counted as sums of these.
FLAGS = ["opens_order", "opens_order_of_product"]
_FINGERPRINT = "key bigint, hash bigint"


@dataclass(frozen=True)
class Refresh:
    """What a run has done to a table: the months it wrote, the keys whose inputs differ (for sales, of
    their orders), and the run of the table that readers see after it."""

    months: list[int]
    changed: DataFrame
    run: int | None


def _fingerprint(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(*rows.columns).alias("hash"))


def _days(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).alias("key"), month_of(dates.date_key(F.col("created_at"))).alias("month"))


def _in_months(months: list[int]) -> Column:
    """Of ``created_at``, as ranges, so that file statistics can skip what lies outside."""
    month = month_of(dates.date_key(F.col("created_at")))
    first, last = min(months), max(months)
    low = F.make_date(F.lit(first // 100), F.lit(first % 100), F.lit(1)).cast("timestamp_ntz")
    high = F.add_months(F.make_date(F.lit(last // 100), F.lit(last % 100), F.lit(1)), 1).cast("timestamp_ntz")
    return (F.col("created_at") >= low) & (F.col("created_at") < high) & month.isin(months)


def first_items(items: DataFrame) -> DataFrame:
    """(order_item_id, flags) of the items that are the first of their order, or of their order and product.

    The least ids are aggregates, combined before the shuffle, so a large order is no large group.
    """
    least = F.min("order_item_id").alias("order_item_id")
    by_order = items.groupBy("order_id").agg(least).select("order_item_id", F.lit(True).alias(FLAGS[0]), F.lit(False).alias(FLAGS[1]))
    by_product = items.groupBy("order_id", "product_id").agg(least).select(
        "order_item_id", F.lit(False).alias(FLAGS[0]), F.lit(True).alias(FLAGS[1])
    )
    return by_order.unionByName(by_product).groupBy("order_item_id").agg(*[F.bool_or(f).alias(f) for f in FLAGS])


class MonthlyFacts:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, f"{root}/monthly"
        self._schemas: dict[str, StructType] = {}
        self._inputs: dict[str, list[str]] = {}

    def table(self, name: str) -> MonthlyTable:
        return MonthlyTable(f"{self.root}/{name}")

    def read(self, name: str, months: list[int] | None = None, run: int | None = None) -> DataFrame:
        return self.table(name).read(self.spark, self._schemas[name], months, run)

    def _refreshed(self, name: str, months: list[int], changed: DataFrame) -> Refresh:
        return Refresh(months, changed, max(self.table(name).runs(self.spark), default=None))

    def drop_old(self, name: str) -> None:
        """Deletes old months, and the fingerprints of runs whose manifest is gone."""
        table = self.table(name)
        table.drop_old(self.spark)
        kept = table.runs(self.spark)
        for source in self._inputs.get(name, []):
            folder = f"{table.root}/fingerprints/{source}"
            for run in finished_numbers(self.spark, folder, "run"):
                if kept and run < kept[0]:
                    delete_folder(self.spark, f"{folder}/run={run}")

    def _changes(self, name: str, inputs: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Per input the keys whose fingerprint differs from the last finished run's, new and gone ones among them.

        A run's fingerprints lie beside its manifest; they count once that is written.
        """
        table = self.table(name)
        self._inputs[name] = list(inputs)
        run, done = table.next_run(self.spark), table.runs(self.spark)
        changed = {}
        for source, prints in inputs.items():
            path = f"{table.root}/fingerprints/{source}"
            prints.write.mode("overwrite").parquet(f"{path}/run={run}")
            now = self.spark.read.schema(_FINGERPRINT).parquet(f"{path}/run={run}").withColumnRenamed("hash", "new")
            if not done:
                changed[source] = now.select("key")
                continue
            before = self.spark.read.schema(_FINGERPRINT).parquet(f"{path}/run={done[-1]}").withColumnRenamed("hash", "old")
            both = now.join(before, "key", "full")
            differ = both.filter(~F.col("new").eqNullSafe(F.col("old"))).select("key")
            changed[source] = self._scratch(name, f"changed-{source}", differ)
        return changed

    def _scratch(self, name: str, part: str, rows: DataFrame) -> DataFrame:
        """Written for this run, since several steps read it; the next run replaces it."""
        path = f"{self.table(name).root}/scratch/{part}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _drop_scratch(self, name: str, *parts: str) -> None:
        """What no later step reads."""
        for part in parts:
            delete_folder(self.spark, f"{self.table(name).root}/scratch/{part}")

    def _take_over(
        self, name: str, key: str, surrogate_key: str, present: DataFrame, build: Build, months: list[int], foreign_keys: list[ForeignKey]
    ) -> None:
        """The months' rows with their lasting keys: known ones keep theirs, new ones continue after the highest.

        ``present`` holds the keys of the rows, and what else was found for them; ``build`` makes the rows out of
        it and the surrogate key. So keys are numbered apart from the rows, and the rows get them in a join that
        they go through anyway.
        """
        if not months:
            return
        table = self.table(name)
        before = self.read(name, months)
        # Each key with what it has so far: numbering reads its input twice, and rows that left are found by it too.
        present = self._scratch(name, "present", present.join(before.select(key, surrogate_key), key, "left"))
        # A join by the key would lose them.
        unkeyed = present.filter(F.col(key).isNull()).count()
        if unkeyed:
            raise ConstraintError(f"{name}: NULL in {key} ({unkeyed} rows)")
        known, unseen = present.filter(F.col(surrogate_key).isNotNull()), present.filter(F.col(surrogate_key).isNull())
        highest = F.lit(table.highest_key(self.spark)).cast("bigint")
        lasting = known.unionByName(surrogate.assign(unseen.drop(surrogate_key), [key], surrogate_key, start=highest))
        rows = build(lasting).withColumn("month", month_of(F.col("date_key")))
        # Rows whose source is gone stay.
        left = before.join(present, key, "left_anti")
        state = rows.select(before.columns).unionByName(left)
        required = [c for c in state.columns if c not in OPTIONAL]
        guarded = guard(state, name, required, foreign_keys, highest=F.max(surrogate_key))
        table.write(guarded, months, surrogate_key, unique=[key])
        self._drop_scratch(name, "present")

    def _months(self, new: DataFrame, stored: DataFrame | None, keys: DataFrame) -> list[int]:
        """Months of changed rows, as they are now and as they were; as many as there are months.

        ``new`` and ``stored`` are (key, month). Without stored rows everything is new.
        """
        if stored is None:
            return sorted(r.month for r in new.select("month").distinct().collect())
        parts = [rows.join(keys, "key", "left_semi").select("month").distinct() for rows in (new, stored)]
        return sorted({r.month for r in reduce(DataFrame.unionByName, parts).collect()})

    def refresh_sales(self, staged: Tables, dims: Tables) -> Refresh:
        name, items, orders = "fact_sales", staged["order_items"], staged["orders"]
        empty = facts.fact_sales(staged, dims).withColumns({f: F.lit(True) for f in FLAGS}).withColumn("month", F.lit(0))
        self._schemas[name] = StructType([StructField("sales_key", LongType()), *empty.schema.fields])
        changed = self._changes(
            name,
            {
                "order_items": _fingerprint(items, "order_item_id"),
                "orders": _fingerprint(orders.select("order_id", "website_session_id", "user_id"), "order_id"),
                "refunds": _fingerprint(facts.refunds_by_item(staged["order_item_refunds"]), "order_item_id"),
            },
        )
        first_run = not self.table(name).runs(self.spark)
        if first_run:
            stored, touched = None, changed["orders"]
        else:
            # Flags depend on all items of an order, so an order changes as a whole.
            item_keys = changed["order_items"].unionByName(changed["refunds"])
            lines = items.select(F.col("order_item_id").alias("key"), "order_id")
            stored = self.read(name)
            order_keys = [
                rows.join(item_keys, "key", "left_semi").select(F.col("order_id").alias("key"))
                for rows in (lines, stored.select(F.col("order_item_id").alias("key"), "order_id"))
            ]
            orders_of = reduce(DataFrame.unionByName, [*order_keys, changed["orders"]]).distinct()
            touched = self._scratch(name, "keys", orders_of)
            self._drop_scratch(name, *[f"changed-{source}" for source in changed])
            stored = stored.select(F.col("order_id").alias("key"), "month")
        months = self._months(_days(items, "order_id"), stored, touched)
        if months:
            some = {**staged, "order_items": items.filter(_in_months(months))}
            related = items if first_run else items.join(some["order_items"].select("order_id"), "order_id", "left_semi")

            # Written along with the keys: the shuffles behind them are over before whole rows are shuffled.
            found = facts.sold_items(some, dims).join(first_items(related), "order_item_id", "left")
            present = found.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in FLAGS})
            build = lambda lasting: facts.fact_sales_of(some, lasting)
            days = dims["dim_date"]
            calendar = [ForeignKey(c, days, "date_key") for c in ("date_key", "refund_date_key")]
            self._take_over(name, "order_item_id", "sales_key", present, build, months, calendar)
        return self._refreshed(name, months, touched)

    def refresh_sessions(self, staged: Tables, dims: Tables, visits: DataFrame) -> Refresh:
        name, sessions = "fact_sessions", staged["website_sessions"]
        empty = facts.fact_sessions(staged, dims, visits).withColumn("month", F.lit(0))
        self._schemas[name] = StructType([StructField("session_key", LongType()), *empty.schema.fields])
        changed = self._changes(
            name,
            {
                "sessions": _fingerprint(sessions, "website_session_id"),
                "visits": _fingerprint(visits, "website_session_id"),
                "orders": _fingerprint(facts.orders_by_session(staged["orders"]), "website_session_id"),
            },
        )
        first_run = not self.table(name).runs(self.spark)
        keys = self._scratch(name, "keys", reduce(DataFrame.unionByName, changed.values()).distinct())
        self._drop_scratch(name, *[f"changed-{source}" for source in changed])
        stored = None if first_run else self.read(name).select(F.col("website_session_id").alias("key"), "month")
        months = self._months(_days(sessions, "website_session_id"), stored, keys)
        if months:
            some = {**staged, "website_sessions": sessions.filter(_in_months(months))}
            calendar = [ForeignKey("date_key", dims["dim_date"], "date_key")]
            present = facts.visited_sessions(some, dims, visits)
            build = lambda lasting: facts.fact_sessions(some, dims, visits, lasting)
            self._take_over(name, "website_session_id", "session_key", present, build, months, calendar)
        return self._refreshed(name, months, keys)
