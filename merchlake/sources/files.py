"""File sources: CSV exports, the JSON catalogue and landed pages of the order service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType, StringType, StructField, StructType

from merchlake import schemas
from merchlake.sources import quoted_csv

DEFAULT_PAGE_SIZE = 1000
MAX_PAGE_SIZE = 5000
DEFAULT_CHUNK_SIZE = 100_000


# Texts the exports use for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Columns are found by the names in the header, which all files of an export share, and broken
# lines raise at the first action; a missing path already fails when the reader is built.
_CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST", "escape": '"'}
# Whole numbers as exported from columns that hold missing values.
_WHOLE = r"^\s*([+-]?[0-9]+)\.0+\s*$"


def _typed(text_rows: DataFrame, schema: StructType) -> DataFrame:
    """Missing texts become NULL, the rest is cast; missing columns and unreadable values raise."""
    missing = sorted(set(schema.fieldNames()) - set(text_rows.columns))
    if missing:
        raise ValueError(f"Missing columns: {', '.join(missing)}")

    def typed(field: StructField) -> Column:
        text = F.col(field.name).cast("string")
        known = F.when(~text.isin(MISSING_TEXTS), text)
        if isinstance(field.dataType, IntegralType):
            known = F.regexp_replace(known, _WHOLE, "$1")
        return known.cast(field.dataType).alias(field.name)

    return text_rows.select(*[typed(f) for f in schema.fields])


def _csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """Texts may hold line breaks inside quotes; both ways read a file split by split, but an export
    without such texts needs one scan only (``multi_line=False``)."""
    if multi_line:
        return _typed(quoted_csv.read(spark, path, _CSV_OPTIONS), schema)
    return _typed(spark.read.options(**_CSV_OPTIONS).csv(path), schema)


def read_sessions(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return _csv(spark, path, schemas.SESSIONS, multi_line)


def read_pageviews(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Whole pageview export; Spark reads it split by split, so memory stays bounded."""
    return _csv(spark, path, schemas.PAGEVIEWS, multi_line)


def read_pageview_chunks(spark: SparkSession, path: str, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Pageviews with their ``file``, their ``row`` in it and their ``chunk``: rows 1 to ``chunk_size``
    of a file are chunk 0, the next ones chunk 1. No task reads more than a file split."""
    if chunk_size <= 0:
        raise ValueError("chunk_size must be greater than zero")
    place = StructType([StructField(c, LongType()) for c in ("file", "row")])
    rows = quoted_csv.read(spark, path, _CSV_OPTIONS)
    typed = _typed(rows, StructType(place.fields + schemas.PAGEVIEWS.fields))
    return typed.withColumn("chunk", F.floor((F.col("row") - 1) / chunk_size))


def stream_pageviews(
    spark: SparkSession, folder: str, files_per_batch: int = 1, bytes_per_batch: int | None = None
) -> DataFrame:
    """Pageview exports as a stream, ``files_per_batch`` files or about ``bytes_per_batch`` at a time.

    The header of the exports that have landed names the columns.
    """
    if files_per_batch <= 0:
        raise ValueError("files_per_batch must be greater than zero")
    landed = spark.read.options(**_CSV_OPTIONS).csv(folder).columns or schemas.PAGEVIEWS.fieldNames()
    reader = spark.readStream.schema(StructType([StructField(c, StringType()) for c in landed]))
    if bytes_per_batch is None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return _typed(reader.options(**_CSV_OPTIONS).csv(folder), schemas.PAGEVIEWS)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product catalogue: one JSON array per file."""
    return (
        spark.read.schema(schemas.PRODUCTS)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
    )


def _order_rows(pages: DataFrame) -> DataFrame:
    # Every page names the same fixed columns, so an empty result keeps its types.
    return schemas.conform(pages.selectExpr("inline(orders)"), schemas.ORDERS)


def read_order_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows out of landed response pages, one JSON document per page."""
    return _order_rows(
        spark.read.schema(schemas.ORDER_PAGE)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(folder)
    )


def stream_order_pages(
    spark: SparkSession, folder: str, files_per_batch: int = 100, bytes_per_batch: int | None = None
) -> DataFrame:
    """Landed order pages as a stream, ``files_per_batch`` files or about ``bytes_per_batch`` at a time."""
    if files_per_batch <= 0:
        raise ValueError("files_per_batch must be greater than zero")
    reader = spark.readStream.schema(schemas.ORDER_PAGE)
    if bytes_per_batch is None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return _order_rows(
        reader.option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(folder)
    )


def read_orders_csv(spark: SparkSession, path: str) -> DataFrame:
    """Order export of the local order source."""
    return _csv(spark, path, schemas.ORDERS)


def sort_orders(orders: DataFrame) -> DataFrame:
    """Keyset order; a range-partitioned sort, so no task sees more than its range."""
    return orders.orderBy("created_at", "order_id")


def order_page(
    orders: DataFrame, limit: int = DEFAULT_PAGE_SIZE, offset: int = 0
) -> DataFrame:
    """One page in keyset order.

    Each task keeps ``offset + limit`` rows at most, so this suits the first pages. To walk a
    long list, move the keyset checkpoint forward (``keyset.after``) instead of the offset.
    """
    if not 1 <= limit <= MAX_PAGE_SIZE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE_SIZE}")
    if offset < 0:
        raise ValueError("offset cannot be negative")
    return sort_orders(orders).offset(offset).limit(limit)


def order_by_id(orders: DataFrame, order_id: int) -> DataFrame:
    """The order with this id (a pushed-down point filter)."""
    return orders.filter(F.col("order_id") == order_id)


def require_order(orders: DataFrame, order_id: int) -> dict:
    """As :func:`order_by_id`, but an unknown id raises."""
    rows = order_by_id(orders, order_id).take(1)
    if not rows:
        raise LookupError(f"Order {order_id} not found")
    return rows[0].asDict()
