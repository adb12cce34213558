"""Pageviews in bounded batches: the first batch replaces the staged table, later ones extend it.

A stream's batches are whole files; ``load_chunks`` cuts files into chunks of rows. Uniqueness is
checked within a batch or chunk. Loading the export as a whole
(``sources.files.read_pageviews``) checks it over all rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from merchlake import schemas
from merchlake.operators.quarantine import quarantine
from merchlake.operators.transforms import transform_pageviews
from merchlake.operators.validators import validate_pageview_chunks, validate_pageviews
from merchlake.plans.facts import visit_states, visits_of
from merchlake.sources import files


def load_batch(batch: DataFrame, number: int, folder: str, rejected_folder: str) -> None:
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = validate_pageviews(batch)
        quarantine(
            parts.rejected, "website_pageviews", f"batch-{number}", rejected_folder, replace=True
        )
        # Batch 0 overwrites the table, any other only its own partition: replays are harmless.
        overwrite = "static" if number == 0 else "dynamic"
        (
            transform_pageviews(parts.valid)
            .withColumn("batch", F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", overwrite)
            .partitionBy("batch")
            .parquet(folder)
        )
    finally:
        batch.unpersist()


def stream_pageviews(
    spark: SparkSession,
    export_folder: str,
    folder: str,
    rejected_folder: str,
    checkpoint: str,
    files_per_batch: int = 1,
) -> StreamingQuery:
    """Loads everything that has landed, ``files_per_batch`` files at a time, then stops."""
    exports = files.stream_pageviews(spark, export_folder, files_per_batch)
    return (
        exports.writeStream.foreachBatch(
            lambda batch, number: load_batch(batch, number, folder, rejected_folder)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_chunks(
    spark: SparkSession,
    export: str,
    folder: str,
    rejected_folder: str,
    run_id: str,
    chunk_size: int = files.DEFAULT_CHUNK_SIZE,
) -> DataFrame:
    """Stages an export chunk by chunk in one job and returns the rows extracted, loaded and rejected
    per chunk. The chunks together replace the staged table, so a repeated call changes nothing.
    """
    raw = f"{folder}-raw"
    files.read_pageview_chunks(spark, export, chunk_size).write.mode("overwrite").parquet(raw)
    chunks = spark.read.parquet(raw)
    parts = validate_pageview_chunks(chunks)
    (
        transform_pageviews(parts.valid.drop("_key_in_chunk"))
        .hint("rebalance", "file", "chunk")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("file", "chunk")
        .parquet(folder)
    )
    rejected = parts.rejected.drop("_key_in_chunk")
    quarantine(rejected, "website_pageviews", run_id, rejected_folder, replace=True)
    sides = chunks.select("file", "chunk", F.lit(0).alias("n")).unionByName(
        spark.read.parquet(folder).select(F.col("file").cast("long"), F.col("chunk").cast("long"), F.lit(1).alias("n"))
    )
    extracted, loaded = F.count_if(F.col("n") == 0), F.count_if(F.col("n") == 1)
    return sides.groupBy("file", "chunk").agg(
        extracted.alias("rows_extracted"), loaded.alias("rows_loaded"), (extracted - loaded).alias("rows_rejected")
    )


def add_visit_states(pageviews: DataFrame, folder: str, part: str) -> None:
    """Keeps the page path of each session of one more chunk; the same ``part`` again replaces itself."""
    states = visit_states(pageviews).withColumn("part", F.lit(part))
    (
        states.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part")
        .parquet(folder)
    )


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """The sessions' digests out of all chunks' states, without reading a pageview again."""
    return visits_of(spark.read.parquet(folder).drop("part"))


def staged_pageviews(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).select(*schemas.PAGEVIEWS.fieldNames())
