"""Tables kept by month: a write replaces the months it touches and leaves the others' files alone.

Rows lie under ``data/run=<n>/month=<yyyymm>``. A manifest per run names, for each month, the run
that wrote it last; it is written after the rows, so readers see the old months or the new ones,
never a mixture, and a run that dies leaves the table as it was. One writer per table is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from merchlake.operators.constraints import Guarded
from merchlake.operators.tables import KEPT_VERSIONS, delete_folder, finished_numbers
from merchlake.operators.upsert import require_unique

#: Per month: the run that wrote it, its rows, and the highest surrogate key of the table at that time.
MANIFEST = "month int, run bigint, rows bigint, highest bigint"
_PLACE = [StructField("run", LongType()), StructField("month", IntegerType())]


def month_of(date_key: Column) -> Column:
    """The month, as yyyymm, of a day given as yyyymmdd."""
    return F.floor(date_key / 100).cast("int")


@dataclass(frozen=True)
class Month:
    run: int
    rows: int


@dataclass(frozen=True)
class MonthlyTable:
    root: str

    def runs(self, spark: SparkSession) -> list[int]:
        return finished_numbers(spark, f"{self.root}/manifest", "v")

    def next_run(self, spark: SparkSession) -> int:
        return max(self.runs(spark), default=0) + 1

    def _manifest(self, spark: SparkSession, run: int) -> list:
        """As many rows as months."""
        return spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/v={run}").collect()

    def months(self, spark: SparkSession, run: int | None = None) -> dict[int, Month]:
        """The months of the newest state, or as ``run`` left them."""
        done = self.runs(spark) if run is None else [run]
        rows = self._manifest(spark, done[-1]) if done else []
        return {r.month: Month(r.run, r.rows) for r in rows}

    def highest_key(self, spark: SparkSession) -> int:
        done = self.runs(spark)
        return max((r.highest or 0 for r in self._manifest(spark, done[-1])), default=0) if done else 0

    def read(
        self, spark: SparkSession, schema: StructType, months: list[int] | None = None, run: int | None = None
    ) -> DataFrame:
        """The newest state (or that of ``run``), or ``months`` of it, with the column ``month``; only these
        months' files are opened."""
        known = self.months(spark, run)
        wanted = sorted(known if months is None else set(known) & set(months))
        full = StructType([f for f in schema.fields if f.name not in ("run", "month")] + _PLACE)
        if not wanted:
            return spark.createDataFrame([], full).drop("run")
        paths = [f"{self.root}/data/run={known[m].run}/month={m}" for m in wanted]
        return spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths).drop("run")

    def write(
        self, guarded: Guarded, touched: list[int], key: str | None = None, unique: list[str] | None = None
    ) -> int:
        """Replaces the months ``touched`` by the guarded rows, which have a column ``month``.

        A month without rows goes. With ``key``, observed as ``highest``, the highest surrogate key is kept.
        The columns ``unique`` are checked as written, before readers see them.
        """
        rows = guarded.rows
        spark = rows.sparkSession
        known, run = self.months(spark), self.next_run(spark)
        folder = f"{self.root}/data/run={run}"
        (
            rows.hint("rebalance", "month")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("month")
            .parquet(folder)
        )
        try:
            guarded.check()
            if unique and guarded.seen.get["rows"]:
                require_unique(spark.read.schema(rows.schema).parquet(folder), unique)
        except ValueError:
            delete_folder(spark, folder)
            raise
        written = {}
        if guarded.seen.get["rows"]:
            counted = spark.read.parquet(folder).groupBy("month").agg(F.count("*").alias("rows"))
            written = {r.month: Month(run, r.rows) for r in counted.collect()}
        state = {m: x for m, x in known.items() if m not in touched} | written
        highest = max(self.highest_key(spark), guarded.seen.get["highest"] or 0) if key else None
        listed = [(m, x.run, x.rows, highest) for m, x in sorted(state.items())]
        manifest = spark.createDataFrame(listed, MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.root}/manifest/v={run}")
        return run

    def drop_old(self, spark: SparkSession, keep: int = KEPT_VERSIONS) -> None:
        """Deletes all manifests but the newest ``keep``, and the months that none of these names."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        runs = self.runs(spark)
        old, kept = runs[:-keep], runs[-keep:]
        if not old:
            return
        needed = {(r.run, r.month) for run in kept for r in self._manifest(spark, run)}
        gone = {(r.run, r.month) for run in old for r in self._manifest(spark, run)} - needed
        for run, month in sorted(gone):
            delete_folder(spark, f"{self.root}/data/run={run}/month={month}")
        for run in old:
            delete_folder(spark, f"{self.root}/manifest/v={run}")
