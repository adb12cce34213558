"""Dense surrogate keys without a global sort.

Rows are cut into a fixed number of buckets by a hash of their business key and numbered inside
each bucket; the bucket's offset is the number of rows in the buckets before it. Both depend on
the row contents only, so a lost task or a second evaluation gives the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the hash: 16 buckets for dimensions of a few rows, 4,096 for large ones.
SMALL, LARGE = 1, 3


def bucket_of(business_key: list[str], digits: int) -> Column:
    joined = F.concat_ws("|", *[F.col(c).cast("string") for c in business_key])
    return F.substring(F.md5(joined), 1, digits)


def _offsets(keys: DataFrame, business_key: list[str], digits: int) -> DataFrame:
    """Rows in the buckets before each bucket: at most 16 ** digits rows, whatever the table size."""
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        keys.groupBy(bucket_of(business_key, digits).alias("_bucket"))
        .agg(F.count("*").alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )


def assign(
    df: DataFrame,
    business_key: list[str],
    name: str,
    digits: int = LARGE,
    start: Column | None = None,
) -> DataFrame:
    """Adds ``name`` = start + 1, start + 2, … The business key must be unique."""
    bucketed = df.withColumn("_bucket", bucket_of(business_key, digits))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*business_key))
    first = F.lit(0) if start is None else F.coalesce(start, F.lit(0))
    return (
        bucketed.withColumn("_rank", rank)
        .join(F.broadcast(_offsets(df.select(*business_key), business_key, digits)), "_bucket")
        .withColumn(name, (first + F.col("_offset") + F.col("_rank")).cast("bigint"))
        .select(name, *df.columns)
    )
