"""A shop's tables over the supplied data, written once per session and shared by all queries.

Staging, dimensions, facts and marts are what a nightly run leaves behind. A query that asks for
a table has it (and what it needs) written to the session's shared work folder on first use;
every later reader scans the written table, with exact sizes and a short lineage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from merchlake.operators.split import Split
from merchlake.plans import analyses, dimensions, facts, marts
from merchlake.plans.lazy import LazyTables, mapped, side_by_side
from merchlake.plans.staging import STAGING_LAYERS, split_of, stage
from merchlake.session import work_folder
from merchlake.sources import supplied


def _writer(folder: str) -> Callable[[str, DataFrame], DataFrame]:
    def write(name: str, rows: DataFrame) -> DataFrame:
        path = f"{folder}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    return write


def written(tables: Mapping[str, DataFrame], folder: str) -> LazyTables:
    """The same tables, each written on first use and read back."""
    return mapped(tables, _writer(folder))


class Shop:
    def __init__(self, raw: Mapping[str, DataFrame], folder: str) -> None:
        self.raw = raw
        staging = f"{folder}/staging"
        self.staged = stage(raw, _writer(staging))
        # Numbering reads its input twice, so the members are written out before it.
        members = written(dimensions.members(self.staged), f"{folder}/scratch")
        self.dims = written(dimensions.build_dimensions(self.staged, members), f"{folder}/warehouse")
        self.digests = written(facts.build_digests(self.staged), f"{folder}/scratch")
        self.facts = written(
            facts.build_facts(self.staged, self.dims, self.digests), f"{folder}/warehouse"
        )
        self.warehouse = self.dims | self.facts
        # Marts are built from the written facts; only the analyses read written marts.
        self.marts = marts.build_marts(self.warehouse, self.digests)
        self.analyses = analyses.build_analyses(written(self.marts, f"{folder}/marts"))

    def split(self, name: str) -> Split:
        """Valid and rejected rows of a source; its references point to the written staging."""
        return split_of(name, self.raw, self.staged)

    def build(self) -> None:
        """Writes staging, dimensions and facts."""
        for layer in STAGING_LAYERS:
            side_by_side(self.staged.__getitem__, layer)
        for tables in (self.dims | self.digests, self.facts):
            side_by_side(tables.__getitem__, tables)


_ENTITY_SETS = {"web": supplied.web, "dirty": supplied.dirty, "volume": supplied.volume}
_OPEN: dict[tuple[str, str, str], Shop] = {}


def open_shop(spark: SparkSession, sf_dir: str, entity_set: str) -> Shop:
    """Every set goes through the rules."""
    key = (spark.sparkContext.applicationId, sf_dir, entity_set)
    if key not in _OPEN:
        number = sum(k[0] == key[0] for k in _OPEN)
        folder = f"{work_folder(spark)}/shop-{number}-{entity_set}"
        raw = _ENTITY_SETS[entity_set](spark, sf_dir)
        _OPEN[key] = Shop(raw, folder)
    return _OPEN[key]
