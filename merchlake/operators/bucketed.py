"""Versioned tables whose files are buckets of their key, and an upsert that does not shuffle them.

A version is written in ``buckets`` buckets by its key, rows sorted by it. A reader that knows the
layout gets each bucket as one partition, so joining by the key shuffles the other side only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.operators import surrogate
from merchlake.operators.tables import VersionedTable, delete_folder


@dataclass(frozen=True)
class BucketedTable(VersionedTable):
    """As a VersionedTable, also for readers that do not know the buckets."""

    keys: tuple[str, ...] = ()
    buckets: int = 200

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        if partition_by:
            raise ValueError("A bucketed table has no partition columns")
        spark = df.sparkSession
        done = self.versions(spark)
        number = done[-1] + 1 if done else 1
        path = f"{self.root}/v={number}"
        name = f"bucketed_{uuid.uuid4().hex}"
        delete_folder(spark, path)
        writer = df.write.format("parquet").mode("overwrite").option("path", path)
        try:
            writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(name)
        finally:
            # The files are the table; its name was needed for the write only.
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        return number

    def read_buckets(self, spark: SparkSession) -> DataFrame:
        """The newest version with its buckets as partitions; it must have been written with as many."""
        done = self.versions(spark)
        if not done:
            raise FileNotFoundError(f"No complete version under {self.root}")
        path = f"{self.root}/v={done[-1]}"
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        name = f"bucketed_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        try:
            return spark.table(name)
        finally:
            spark.sql(f"DROP TABLE {name}")


def upsert_buckets(
    stored: DataFrame, source: DataFrame, keys: list[str], surrogate_key: str, digits: int = surrogate.LARGE
) -> DataFrame:
    """The state of ``stored`` (read by buckets) after taking over ``source``; as ``upsert.upsert``.

    Both joins move the source only. New members are numbered apart and bring their number along, so
    no row of the stored side is shuffled for its key either.
    """
    columns = [c for c in stored.columns if c not in (surrogate_key, *keys)]
    unseen = source.select(*keys).join(stored.select(*keys), keys, "left_anti")
    highest = F.lit(stored.agg(F.max(surrogate_key)).first()[0])
    new = surrogate.assign(unseen, keys, surrogate_key, digits, highest).withColumnRenamed(surrogate_key, "_new")
    theirs = source.join(new, keys, "left").withColumn("_taken", F.lit(True)).alias("s")
    ours = stored.alias("t")
    same = [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys]
    taken = F.col("s._taken").isNotNull()
    state = ours.join(theirs, same, "full").select(
        F.coalesce(F.col(f"t.`{surrogate_key}`"), F.col("s._new")).alias(surrogate_key),
        *[F.coalesce(F.col(f"t.`{k}`"), F.col(f"s.`{k}`")).alias(k) for k in keys],
        *[F.when(taken, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in columns],
    )
    return state.select(*stored.columns)
