"""One complete run: six sources to staging, warehouse and marts, with a run log."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime
from decimal import Decimal
from time import perf_counter
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.operators import runlog, validators
from merchlake.operators.increments import OrderStore
from merchlake.operators.keyset import Watermark
from merchlake.operators.quarantine import quarantine
from merchlake.operators.split import Split
from merchlake.operators.tables import VersionedTable
from merchlake.operators.transforms import TRANSFORMS, transform_orders
from merchlake.plans import analyses
from merchlake.plans.staging import split_of
from merchlake.plans.warehouse import UPSERT, build_warehouse, load_marts


# Step names by source, in launch order.
STEP_NAMES = {
    "website_sessions": "staging_sessions",
    "website_pageviews": "staging_pageviews",
    "products": "staging_products",
    "orders": "staging_orders",
    "order_items": "staging_order_items",
    "order_item_refunds": "staging_refunds",
}
WAREHOUSE_STEP = "warehouse_et_marts"
LOGS = {"pipeline_runs": schemas.RUN_LOG, "pipeline_step_runs": schemas.STEP_LOG}


@dataclass(frozen=True)
class RunSources:
    """Source batches; orders are asked for from a checkpoint on."""

    website_sessions: DataFrame
    website_pageviews: DataFrame
    products: DataFrame
    orders_after: Callable[[Watermark], DataFrame]
    order_items: DataFrame
    order_item_refunds: DataFrame


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class FullRun:
    def __init__(self, spark: SparkSession, root: str, mode: str = UPSERT) -> None:
        self.spark, self.root, self.mode = spark, root, mode
        self.run_id = str(uuid4())
        # Rows extracted, loaded and rejected over all sources.
        self.rows: Counter[str] = Counter()
        self.orders = OrderStore(f"{root}/staging/orders")
        self._step_number = 0

    # control tables

    def _log(self, table: str, schema, *values) -> None:
        runlog.append_log(self.spark, f"{self.root}/control/{table}", schema, values)

    def _log_run(self, status: str, error: str | None = None) -> None:
        self._log(
            "pipeline_runs", schemas.RUN_LOG, self.run_id, runlog.PIPELINE_NAME, _now(), status,
            self.rows["extracted"], self.rows["loaded"], self.rows["rejected"], error,
        )

    def _log_step(self, name: str, status: str, seconds=None, rows: int = 0, error=None) -> None:
        self._log(
            "pipeline_step_runs", schemas.STEP_LOG, self.run_id, self._step_number, name, _now(),
            status, seconds, rows, error,
        )

    @contextmanager
    def _step(self, name: str) -> Iterator[Counter[str]]:
        self._step_number += 1
        self._log_step(name, runlog.STARTED)
        done, started = Counter(), perf_counter()

        def seconds() -> Decimal:
            return Decimal(perf_counter() - started).quantize(Decimal("0.001"))

        try:
            yield done
        except Exception as error:
            self._log_step(name, runlog.FAILED, seconds(), done["loaded"], str(error))
            raise
        self._log_step(name, runlog.SUCCESS, seconds(), done["loaded"])

    # staging

    def staged_table(self, name: str) -> VersionedTable:
        return VersionedTable(f"{self.root}/staging/{name}")

    def _land(self, source: str, rows: DataFrame) -> DataFrame:
        """Reads a source once, into a raw table; both sides of the split are cut from that table.

        A live source may change between two reads, and a row would then be on both sides or none.
        """
        table = VersionedTable(f"{self.root}/landing/{source}")
        table.write(rows)
        table.drop_old(self.spark, keep=1)
        return table.read(self.spark, rows.schema)

    def _load(self, step_name: str, source: str, split: Callable[[], Split]) -> DataFrame:
        """Quarantines the rejected rows and replaces the staged table by the valid ones."""
        with self._step(step_name) as done:
            parts = split()
            rejected = quarantine(parts.rejected, source, self.run_id, f"{self.root}/rejected")
            loaded = Observation()
            rows = TRANSFORMS[source](parts.valid).observe(loaded, F.count("*").alias("rows"))
            self.staged_table(source).write(rows)
            self.staged_table(source).drop_old(self.spark)
            self._record(done, loaded.get["rows"], rejected)
        return self.staged_table(source).read(self.spark, schemas.STAGED[source])

    def _load_orders(self, step_name: str, orders_after: Callable[[Watermark], DataFrame]) -> DataFrame:
        """Takes over the orders behind the checkpoint; both advance together or not at all."""
        with self._step(step_name) as done:
            increment = self._land("orders", orders_after(self.orders.watermark(self.spark)))
            parts = validators.validate_orders(increment)
            rejected = quarantine(parts.rejected, "orders", self.run_id, f"{self.root}/rejected")
            loaded = Observation()
            valid = transform_orders(parts.valid).observe(loaded, F.count("*").alias("rows"))
            self.orders.append(valid)
            self._record(done, loaded.get["rows"], rejected)
            self.orders.compact_if_due(self.spark)
        return self.orders.read(self.spark)

    def _record(self, step: Counter[str], loaded: int, rejected: int) -> None:
        step.update(extracted=loaded + rejected, loaded=loaded, rejected=rejected)
        self.rows.update(step)

    def _stage(self, sources: RunSources) -> dict[str, DataFrame]:
        raw = {name: getattr(sources, name) for name in STEP_NAMES if name != "orders"}
        staged: dict[str, DataFrame] = {}
        for name, step_name in STEP_NAMES.items():
            if name == "orders":
                staged[name] = self._load_orders(step_name, sources.orders_after)
            else:
                staged[name] = self._load(
                    step_name,
                    name,
                    lambda name=name: split_of(name, {**raw, name: self._land(name, raw[name])}, staged),
                )
        return staged

    def run(self, sources: RunSources) -> str:
        """Returns the run id; a failure is logged and raised."""
        self._log_run(runlog.STARTED)
        try:
            staged = self._stage(sources)
            with self._step(WAREHOUSE_STEP) as done:
                result = build_warehouse(self.spark, staged, self.root, self.mode)
                done["loaded"] = sum(result.volumes.values())
        except Exception as error:
            self._finish(runlog.FAILED, str(error))
            raise
        self._finish(runlog.SUCCESS)
        return self.run_id

    def _finish(self, status: str, error: str | None = None) -> None:
        runlog.require_final(status)
        self._log_run(status, error)
        for table, schema in LOGS.items():
            runlog.fold_log(self.spark, f"{self.root}/control/{table}", schema)


def report(spark: SparkSession, root: str, folder: str) -> Mapping[str, DataFrame]:
    """Analyses of the written marts, exported as CSV under ``folder``."""
    results = analyses.build_analyses(load_marts(spark, root))
    analyses.export_analyses(results, folder)
    return results


def run_log(spark: SparkSession, root: str) -> DataFrame:
    return runlog.read_log(spark, f"{root}/control/pipeline_runs", schemas.RUN_LOG)


def step_log(spark: SparkSession, root: str) -> DataFrame:
    return runlog.read_log(spark, f"{root}/control/pipeline_step_runs", schemas.STEP_LOG)
