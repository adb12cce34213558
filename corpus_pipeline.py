"""A corpus pipeline: rejects poor documents, removes repeated lines and near copies, mixes sources,
and encodes the texts. Each stage reads what its predecessor has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import op01_quality, op03_minhash, op04_lines, op07_mixing, op10_pieces
from merchlake.llm.common import Scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good; it learns from the table ``labels``.

    Rows without id are scored like others. Rows that repeat an id share the best of its scores.
    """
    judged = op01_quality.classify(docs, table(spark, sf_dir, "labels"))
    good = judged.groupBy("doc_id").agg(F.max("predicted").alias("predicted")).filter("predicted = 1").select("doc_id")
    return _with(docs, good)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat others; n_chars follows the text.

    A document that has lost all its visible lines goes: each line is linked to one kept elsewhere, in
    the same or different documents, directly or by chain (character shingles, Jaccard 0.8). This is
    looser than near_copies, which might have kept it. One that was empty before stays.
    """
    deduplicated = op04_lines.deduplicate_lines(docs, carry=[c for c in docs.columns if c not in ("doc_id", "text")])
    visible = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", "")) > 0
    kept = deduplicated.filter((F.col("n_removed") == 0) | visible)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies. Rows that repeat an id with the same text are one
    document; rows without id are linked with nothing and all stay. Texts without words stay."""
    judged = op03_minhash.near_duplicates(docs)
    stays = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("kept").select("doc_id")
    if _repeats(docs):
        named = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
        docs = named.unionByName(docs.filter("doc_id IS NULL"))
    return _with(docs, stays)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights, in random order. A null source is one of its own; rows
    that repeat an id, or have none, come as often as each other; an empty table stays empty."""
    return op07_mixing.mix(docs).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and whether they decode to it. Null and empty texts have none; repeated
    rows and rows without id are encoded one by one; an empty table stays empty."""
    return op10_pieces.encode(docs.select("doc_id", "source", "text"), checked_column="round_trip").select(
        "doc_id", "source", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "round_trip"
    )


def _repeats(docs: DataFrame) -> bool:
    """Whether some id has several rows."""
    counted = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    return bool(counted.take(1))


def _with(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose id is among ``ids``, null among them if it is there."""
    return docs.join(ids.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("pieces", pieces),
]

#: No SQL can express the learned model of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's rows are written and read again by the next one."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
