"""Checkpoint table: one position per (pipeline, source)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.operators.keyset import EMPTY, Watermark
from merchlake.operators.runlog import PIPELINE_NAME
from merchlake.operators.upsert import upsert

KEYS = ["pipeline_name", "source_name"]


def get_watermark(
    table: DataFrame, source_name: str, pipeline_name: str = PIPELINE_NAME
) -> Watermark:
    """Position of one source, empty when it has none (a point lookup)."""
    rows = (
        table.filter(
            (F.col("pipeline_name") == pipeline_name) & (F.col("source_name") == source_name)
        )
        .select("last_created_at", "last_id")
        .take(1)
    )
    return Watermark(rows[0].last_created_at, rows[0].last_id) if rows else EMPTY


def set_watermarks(table: DataFrame, updates: DataFrame) -> DataFrame:
    """State of the table after ``updates``; an update without both parts raises."""
    complete = F.col("last_created_at").isNotNull() & F.col("last_id").isNotNull()
    message = "A checkpoint update requires both of its parts"
    # The check rides on a column that is written, so it cannot be pruned away.
    checked = updates.withColumn(
        "last_id",
        F.when(complete, F.col("last_id")).otherwise(F.raise_error(F.lit(message)).cast("bigint")),
    )
    return upsert(table, checked, KEYS)
