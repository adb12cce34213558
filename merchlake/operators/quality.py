"""Constraint checks: keys, NOT NULL, references and value domains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: how many NULLs it holds. A single pass over the table."""
    names = columns or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in names]
    )
    return counted.select(F.inline(pairs))


def orphans(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Rows whose non-NULL reference does not exist."""
    ids = reference.select(F.col(reference_column).alias("_ref_id")).distinct()
    return df.filter(F.col(column).isNotNull()).join(
        ids, F.col(column) == F.col("_ref_id"), "left_anti"
    )


def referenced(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Rows whose reference exists."""
    ids = reference.select(F.col(reference_column).alias("_ref_id")).distinct()
    return df.join(ids, F.col(column) == F.col("_ref_id"), "left_semi")


def outside_domain(df: DataFrame, column: str, allowed: list) -> DataFrame:
    return df.filter(~F.coalesce(F.col(column).isin(allowed), F.lit(False)))


def foreign_key_report(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per (name, table, column, reference, reference column): number of orphans."""
    parts = [
        orphans(df, column, reference, reference_column)
        .agg(F.count("*").alias("orphan_count"))
        .select(F.lit(name).alias("check_name"), "orphan_count")
        for name, df, column, reference, reference_column in checks
    ]
    return reduce(DataFrame.unionByName, parts)
