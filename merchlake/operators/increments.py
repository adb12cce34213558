"""Incremental orders: append an increment, commit it with its checkpoint, merge on read.

``data/run=<n>`` holds the rows of run n, ``commits/run=<n>`` one row with the checkpoint after
it. The commit is written last and readers look at committed runs only, so data and checkpoint
become visible together and a run that dies in between changes nothing. A run costs what its
increment costs; orders staged earlier are not rewritten until ``compact``, which folds all
committed runs into ``base/upto=<n>`` and lists them in ``folded/upto=<n>``.

The store alone gives out run numbers: a writer claims one by creating a file exclusively, so
writers at the same time get different ones, and what both commit is read. A stream's micro-batch
is found again by (stream, batch) in its commit, so a replay changes nothing. The checkpoint never
moves back. Compactions are claimed in the same way and remove only what they have read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from merchlake import schemas
from merchlake.operators import keyset
from merchlake.operators.keyset import Watermark
from merchlake.operators.runlog import PIPELINE_NAME
from merchlake.operators.tables import claim, delete_folder, finished_numbers
from merchlake.operators.upsert import require_keys, require_known

SOURCE_NAME = "orders"
KEY = "order_id"
# Increments merged on read before they are folded into one base.
COMPACT_AFTER = 30
_INCREMENT = StructType([*schemas.STAGED_ORDERS.fields, StructField("run", LongType())])


def latest_per_key(increments: DataFrame, key: str = KEY) -> DataFrame:
    """Rows of the highest ``run`` per key. A key occurs once per run, so no group is large."""
    newest = increments.groupBy(F.col(key).alias("_key")).agg(F.max("run").alias("_newest"))
    superseded = (F.col(key) == F.col("_key")) & (F.col("run") < F.col("_newest"))
    return increments.join(newest, superseded, "left_anti").drop("run")


def merge(base: DataFrame, increments: DataFrame, key: str = KEY) -> DataFrame:
    """``base`` with the newest version of every key in ``increments`` put in.

    Only the increments' keys meet the base. While they measure small the base is scanned
    without a shuffle.
    """
    touched = increments.select(key).distinct()
    return base.join(touched, key, "left_anti").unionByName(latest_per_key(increments, key))


@dataclass(frozen=True)
class _State:
    """What is committed: the base in use, its folded runs, and the commits after it."""

    base: int | None
    folded: list[Row]
    open: list[Row]

    @property
    def position(self) -> Watermark:
        known = [Watermark(r.last_created_at, r.last_id) for r in (*self.folded, *self.open)]
        return max((w for w in known if not w.is_empty), key=_order, default=keyset.EMPTY)

    @property
    def next_run(self) -> int:
        numbers = [r.run for r in (*self.folded, *self.open) if r.run is not None]
        return max([-1 if self.base is None else self.base, *numbers]) + 1

    def has(self, stream: str, batch: int) -> bool:
        """A stream's batches come in order, so of folded ones the last is enough."""
        if any(r.stream == stream and r.batch == batch for r in self.open):
            return True
        return any(r.stream == stream and r.batch >= batch for r in self.folded)


def _order(position: Watermark) -> tuple:
    return position.last_created_at, position.last_id


@dataclass(frozen=True)
class OrderStore:
    root: str

    def _committed(self, spark: SparkSession) -> list[int]:
        return finished_numbers(spark, f"{self.root}/commits", "run")

    def _bases(self, spark: SparkSession) -> list[int]:
        """Compactions; the list of folded runs is written last and so makes one valid."""
        return finished_numbers(spark, f"{self.root}/folded", "upto")

    def _rows(self, spark: SparkSession, folders: list[str]) -> list[Row]:
        if not folders:
            return []
        return spark.read.schema(schemas.ORDER_COMMITS).parquet(*folders).collect()

    def _state(self, spark: SparkSession) -> _State:
        bases, runs = self._bases(spark), self._committed(spark)
        base = bases[-1] if bases else None
        folded = self._rows(spark, [] if base is None else [f"{self.root}/folded/upto={base}"])
        taken = {r.run for r in folded}
        rows = self._rows(spark, [f"{self.root}/commits/run={n}" for n in runs if n not in taken])
        return _State(base, folded, sorted(rows, key=lambda r: r.run))

    def next_run(self, spark: SparkSession) -> int:
        return self._state(spark).next_run

    def open_runs(self, spark: SparkSession) -> int:
        """Runs that a read merges into the base."""
        state = self._state(spark)
        return max(0, len(state.open) - (state.base is None))

    def read(self, spark: SparkSession) -> DataFrame:
        """Current state of the staged orders."""
        return self._read(spark, self._state(spark))

    def _read(self, spark: SparkSession, state: _State) -> DataFrame:
        runs = [r.run for r in state.open]
        if state.base is not None:
            start = f"base/upto={state.base}"
        elif runs:
            start, runs = f"data/run={runs[0]}", runs[1:]
        else:
            return spark.createDataFrame([], schemas.STAGED_ORDERS)
        base = spark.read.schema(schemas.STAGED_ORDERS).parquet(f"{self.root}/{start}")
        if not runs:
            return base
        folder = f"{self.root}/data"
        increments = (
            spark.read.schema(_INCREMENT)
            .option("basePath", folder)
            .parquet(*[f"{folder}/run={n}" for n in runs])
        )
        return merge(base, increments)

    def watermark(self, spark: SparkSession) -> Watermark:
        """The highest checkpoint that was committed."""
        return self._state(spark).position

    def append(
        self, staged: DataFrame, stream: str | None = None, batch: int | None = None
    ) -> Watermark | None:
        """Takes over valid, transformed orders and advances the checkpoint.

        A micro-batch names its stream and number; if it is committed already, nothing happens.
        Without rows nothing moves and None is returned.
        """
        spark = staged.sparkSession
        state = self._state(spark)
        if stream is not None and state.has(stream, batch):
            return state.position
        rows = schemas.conform(staged, schemas.STAGED_ORDERS)
        require_known(rows, [KEY, "created_at"])
        number = self._claimed(spark, "run", state.next_run)
        path = f"{self.root}/data/run={number}"
        rows.write.mode("overwrite").parquet(path)
        written = spark.read.schema(schemas.STAGED_ORDERS).parquet(path)
        if written.isEmpty():
            return None
        require_keys(written, [KEY])
        here = Watermark(*keyset.checkpoint(written).first())
        position = here if state.position.is_empty else max(state.position, here, key=_order)
        self._commit(spark, f"commits/run={number}", [_commit_row(number, position, stream, batch)])
        return position

    def _claimed(self, spark: SparkSession, kind: str, number: int) -> int:
        """The first number from ``number`` on that no other writer has; one that dies leaves a gap."""
        while not claim(spark, f"{self.root}/claims/{kind}={number}"):
            number += 1
        return number

    def _commit(self, spark: SparkSession, folder: str, rows: list[tuple]) -> None:
        """Refuses to write a number twice."""
        spark.createDataFrame(rows, schemas.ORDER_COMMITS).coalesce(1).write.mode(
            "errorifexists"
        ).parquet(f"{self.root}/{folder}")

    def compact(self, spark: SparkSession) -> int | None:
        """Folds all committed runs into one base; later reads start there.

        The base lies in keyset order, so file statistics skip what is at or before a checkpoint.

        The base before this one and its runs' data stay, since they still serve readers that
        planned earlier; what is older is deleted, and so are the commits that were folded. Per
        stream the last batch stays known.
        """
        state = self._state(spark)
        if not state.open or (state.base is None and len(state.open) == 1):
            return None
        number = state.open[-1].run
        if state.base is not None and number < state.base or not claim(spark, f"{self.root}/claims/base={number}"):
            return None
        path = f"{self.root}/base/upto={number}"
        position = ["created_at", KEY]
        in_order = self._read(spark, state).repartitionByRange(*position).sortWithinPartitions(*position)
        in_order.write.mode("overwrite").parquet(path)
        self._commit(spark, f"folded/upto={number}", _folded_rows(state))
        # Only what this compaction has read: another writer may commit meanwhile.
        for row in state.open:
            delete_folder(spark, f"{self.root}/commits/run={row.run}")
        if state.base is not None:
            for row in state.folded:
                if row.run is not None:
                    delete_folder(spark, f"{self.root}/data/run={row.run}")
            for upto in self._bases(spark)[:-2]:
                delete_folder(spark, f"{self.root}/folded/upto={upto}")
                delete_folder(spark, f"{self.root}/base/upto={upto}")
        return number

    def compact_if_due(self, spark: SparkSession, after: int = COMPACT_AFTER) -> int | None:
        return self.compact(spark) if self.open_runs(spark) >= after else None


def _commit_row(run: int | None, position: Watermark, stream: str | None, batch: int | None) -> tuple:
    now = datetime.now(UTC).replace(tzinfo=None)
    return (
        PIPELINE_NAME, SOURCE_NAME, position.last_created_at, position.last_id, now, run, stream, batch
    )


def _folded_rows(state: _State) -> list[tuple]:
    """The runs of this compaction, and the last batch of each stream folded before."""
    rows = [
        _commit_row(r.run, Watermark(r.last_created_at, r.last_id), r.stream, r.batch) for r in state.open
    ]
    last: dict[str, int] = {}
    for r in state.folded:
        if r.stream is not None:
            last[r.stream] = max(r.batch, last.get(r.stream, -1))
    rows += [_commit_row(None, state.position, stream, batch) for stream, batch in last.items()]
    return rows
