"""Ordered build of the warehouse: dimensions, facts, reconciliation gate, marts.

Every table is a versioned Parquet table. Later steps read what earlier steps wrote: sizes are
then known exactly, so Spark broadcasts a dimension when it is small and shuffles when it is
not, and a lost executor costs a rescan of one table instead of the whole lineage.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from merchlake.operators import surrogate
from merchlake.operators.bucketed import BucketedTable, upsert_buckets
from merchlake.operators.tables import VersionedTable, finished_numbers
from merchlake.operators.upsert import MissingKeyError, require_keys, require_unique, upsert
from merchlake.plans import dimensions, facts, marts, reconciliation
from merchlake.plans.lazy import side_by_side
from merchlake.plans.mart_states import MartStates
from merchlake.plans.monthly_facts import FLAGS, MonthlyFacts

Tables = Mapping[str, DataFrame]

FACT_KEYS = {"fact_sales": "order_item_id", "fact_sessions": "website_session_id"}
FACT_SURROGATES = {"fact_sales": "sales_key", "fact_sessions": "session_key"}
# Dimensions that grow with the visitors: an upsert joins them bucket by bucket.
BUCKETED = ["dim_customer"]
UPSERT, REBUILD, MONTHLY = "upsert", "rebuild", "monthly"


@dataclass(frozen=True)
class WarehouseResult:
    """Rows written per table, in build order, and the checks that passed."""

    volumes: dict[str, int]
    checks: list[reconciliation.Check]


class WarehouseBuilder:
    """``upsert`` keeps rows that left the sources, ``rebuild`` drops them. ``monthly`` keeps them too, but
    rewrites only the facts' months that have changed, and builds the marts from states kept per month."""

    def __init__(self, spark: SparkSession, root: str, mode: str = UPSERT) -> None:
        if mode not in (UPSERT, REBUILD, MONTHLY):
            raise ValueError(f"mode must be {UPSERT!r}, {REBUILD!r} or {MONTHLY!r}")
        self.spark, self.root, self.mode = spark, root, mode
        self.volumes: dict[str, int] = {}

    def table(self, name: str) -> VersionedTable:
        schema = "marts" if name in marts.MART_KEYS else "warehouse"
        root = f"{self.root}/{schema}/{name}"
        if name in BUCKETED:
            # A table keeps the number of buckets of its first version.
            _, business_key, _ = dimensions.KEYED[name]
            return BucketedTable(root, tuple(business_key), self._buckets(f"{root}/buckets"))
        return VersionedTable(root)

    def _buckets(self, root: str) -> int:
        known = finished_numbers(self.spark, root, "n")
        if known:
            return known[0]
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark.createDataFrame([(n,)], "n int").coalesce(1).write.mode("overwrite").parquet(f"{root}/n={n}")
        return n

    def _write(self, name: str, state: DataFrame, keys: list[str]) -> DataFrame:
        """Writes the next version; one that breaks its key is taken back before anything reads it.

        NULL keys are counted by the write itself; uniqueness is checked on the written key columns.
        """
        written = Observation()
        nulls = F.count_if(reduce(Column.__or__, (F.col(k).isNull() for k in keys)))
        table = self.table(name)
        number = table.write(state.observe(written, F.count("*").alias("rows"), nulls.alias("nulls")))
        rows = table.read(self.spark)
        try:
            if written.get["nulls"]:
                raise MissingKeyError(f"{name}: NULL in {', '.join(keys)}")
            require_unique(rows, keys)
        except ValueError:
            table.take_back(self.spark, number)
            raise
        table.drop_old(self.spark)
        self.volumes[name] = written.get["rows"]
        return rows

    def _scratch(self, name: str, rows: DataFrame) -> DataFrame:
        """Written intermediate result; only the newest version is kept."""
        table = VersionedTable(f"{self.root}/scratch/{name}")
        table.write(rows)
        table.drop_old(self.spark, keep=1)
        return table.read(self.spark)

    def _take_over(self, name: str, source: DataFrame, keys: list[str]) -> DataFrame:
        table = self.table(name)
        if self.mode != REBUILD and table.exists(self.spark):
            source = upsert(table.read(self.spark), source, keys)
        return self._write(name, source, keys)

    def _keyed_dimension(self, name: str, members: DataFrame) -> DataFrame:
        """Known members keep their key in both modes; facts may already refer to it."""
        key, business_key, digits = dimensions.KEYED[name]
        # Numbering reads its input twice, so the members are written out before it.
        members = self._scratch(name, members)
        require_keys(members, business_key)
        table = self.table(name)
        if table.exists(self.spark) and isinstance(table, BucketedTable):
            state = upsert_buckets(table.read_buckets(self.spark), members, business_key, key, digits)
        elif table.exists(self.spark):
            known = table.read(self.spark)
            state = upsert(known, members, business_key, key, digits)
        else:
            state = surrogate.assign(members, business_key, key, digits)
        return self._write(name, state, business_key)

    def dimensions(self, staged: Tables) -> dict[str, DataFrame]:
        calendar = dimensions.build_dim_date_from_staging(staged)
        members = dimensions.members(staged)

        def build(name: str) -> DataFrame:
            if name == "dim_date":
                return self._take_over(name, calendar, ["date_key"])
            return self._keyed_dimension(name, members[name])

        return side_by_side(build, ["dim_date", *members])

    def digests(self, staged: Tables) -> dict[str, DataFrame]:
        """Per-session digest of the pageviews, for the session facts and for the funnel."""
        return {n: self._scratch(n, rows) for n, rows in facts.build_digests(staged).items()}

    def facts(self, staged: Tables, dims: Tables, digests: Tables) -> dict[str, DataFrame]:
        tables = facts.build_facts(staged, dims, digests)
        return side_by_side(
            lambda name: self._take_over(name, tables[name], [FACT_KEYS[name]]), tables
        )

    def monthly_facts(self, staged: Tables, dims: Tables, digests: Tables) -> tuple[dict[str, DataFrame], MartStates]:
        """Both facts, without the columns that only serve their upkeep, and the states of the marts."""
        kept = MonthlyFacts(self.spark, self.root)
        visits = digests["session_visits"]
        sales, sessions = kept.refresh_sales(staged, dims), kept.refresh_sessions(staged, dims, visits)
        states = MartStates(self.spark, kept)
        states.refresh(sales, sessions, visits)
        for name in FACT_KEYS:
            kept.drop_old(name)
            self.volumes[name] = sum(m.rows for m in kept.table(name).months(self.spark).values())
        return {n: kept.read(n).drop(*FLAGS, "month", FACT_SURROGATES[n]) for n in FACT_KEYS}, states

    def monthly_marts(self, states: MartStates, dims: Tables) -> dict[str, DataFrame]:
        tables = states.marts(dims)
        return side_by_side(lambda name: self._write(name, tables[name], marts.MART_KEYS[name]), tables)

    def marts(self, warehouse: Tables, digests: Tables) -> dict[str, DataFrame]:
        tables = marts.build_marts(warehouse, digests)
        return side_by_side(
            lambda name: self._take_over(name, tables[name], marts.MART_KEYS[name]), tables
        )


def build_warehouse(
    spark: SparkSession, staged: Tables, root: str, mode: str = UPSERT
) -> WarehouseResult:
    """Builds everything in dependency order. A failed reconciliation stops before the marts."""
    builder = WarehouseBuilder(spark, root, mode)
    dims = builder.dimensions(staged)
    digests = builder.digests(staged)
    if mode == MONTHLY:
        fact_tables, states = builder.monthly_facts(staged, dims, digests)
    else:
        fact_tables = builder.facts(staged, dims, digests)
    checks = reconciliation.require_reconciled(reconciliation.reconcile(staged, fact_tables))
    if mode == MONTHLY:
        mart_tables = builder.monthly_marts(states, dims)
    else:
        mart_tables = builder.marts({**dims, **fact_tables}, digests)
    in_order = [*dims, *fact_tables, *mart_tables]
    return WarehouseResult({name: builder.volumes[name] for name in in_order}, checks)


def number_facts(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A written fact table with its surrogate row key.

    Not part of the build: nothing joins on this key, and numbering shuffles the whole table.
    """
    rows = VersionedTable(f"{root}/warehouse/{name}").read(spark)
    return surrogate.assign(rows, [FACT_KEYS[name]], FACT_SURROGATES[name])


# Marts behind the analyses, by analysis input.
ANALYSED_MARTS = [
    "daily_performance",
    "customer_summary",
    "marketing_performance",
    "funnel_performance",
    "product_performance",
]


def load_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The five marts the analyses start from; the daily ones in date order."""
    loaded = {
        name: VersionedTable(f"{root}/marts/{name}").read(spark) for name in ANALYSED_MARTS
    }
    for name in ("daily_performance", "funnel_performance"):
        loaded[name] = loaded[name].orderBy("date")
    return loaded
