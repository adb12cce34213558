"""Order increments as a file stream.

Landed response pages are picked up as they arrive. Spark's checkpoint remembers which files are
done; each micro-batch is a run of the order store, found again by the stream's id and the batch's
number, so a batch replayed after a failure is taken over once.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from merchlake.operators.increments import OrderStore
from merchlake.operators.quarantine import quarantine
from merchlake.operators.transforms import transform_orders
from merchlake.operators.validators import validate_orders
from merchlake.sources import files

#: Landed pages of one micro-batch, in bytes.
BATCH_BYTES = 64 * 1024 * 1024


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave this checkpoint; a new checkpoint is a new stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def take_over_batch(
    batch: DataFrame, number: int, store: OrderStore, rejected_folder: str, stream: str
) -> None:
    # Read once for the valid and the rejected side; spills to disk when it does not fit.
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = validate_orders(batch)
        quarantine(parts.rejected, "orders", f"{stream}-{number}", rejected_folder, replace=True)
        store.append(transform_orders(parts.valid), stream, number)
        store.compact_if_due(batch.sparkSession)
    finally:
        batch.unpersist()


def stream_orders(
    spark: SparkSession,
    pages_folder: str,
    store: OrderStore,
    rejected_folder: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    bytes_per_batch: int = BATCH_BYTES,
) -> StreamingQuery:
    """Takes over everything that has landed, then stops.

    A batch costs some seconds whatever it holds, and pages are small files; so a batch is bounded by
    bytes unless the caller names a number of files.
    """
    if files_per_batch is None:
        pages = files.stream_order_pages(spark, pages_folder, bytes_per_batch=bytes_per_batch)
    else:
        pages = files.stream_order_pages(spark, pages_folder, files_per_batch)
    return (
        pages.writeStream.foreachBatch(
            lambda batch, number: take_over_batch(
                batch, number, store, rejected_folder, stream_id(spark, checkpoint)
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
