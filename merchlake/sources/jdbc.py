"""Relational sources, read in parallel ranges of their numeric key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from merchlake import schemas

Bounds = tuple[int, int]


def jdbc_options(
    url: str, table: str, key: str, bounds: Bounds, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    low, high = bounds
    if low > high:
        raise ValueError("lower bound must not exceed upper bound")
    if partitions <= 0:
        raise ValueError("partitions must be greater than zero")
    # The bounds only cut the key range into equal strides; rows outside are still read.
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
    }


def key_bounds(spark: SparkSession, url: str, table: str, key: str, **extra: str) -> Bounds:
    """Smallest and largest key, computed by the database (one row)."""
    query = f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=query, **extra).load().first()
    return (row[0], row[1]) if row[0] is not None else (0, 0)


def _read(
    spark: SparkSession,
    url: str,
    source: tuple[str, str, StructType],
    partitions: int,
    bounds: Bounds | None,
    extra: dict[str, str],
) -> DataFrame:
    table, key, schema = source
    bounds = bounds or key_bounds(spark, url, table, key, **extra)
    options = jdbc_options(url, table, key, bounds, partitions) | extra
    return schemas.conform(spark.read.format("jdbc").options(**options).load(), schema)


def read_order_items(
    spark: SparkSession, url: str, partitions: int, bounds: Bounds | None = None, **extra: str
) -> DataFrame:
    """``extra``: further reader options such as user, password, driver, fetchsize."""
    source = ("source.order_items", "order_item_id", schemas.ORDER_ITEMS)
    return _read(spark, url, source, partitions, bounds, extra)


def read_refunds(
    spark: SparkSession, url: str, partitions: int, bounds: Bounds | None = None, **extra: str
) -> DataFrame:
    source = ("source.order_item_refunds", "order_item_refund_id", schemas.REFUNDS)
    return _read(spark, url, source, partitions, bounds, extra)
