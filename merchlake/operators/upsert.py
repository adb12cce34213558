"""Keyed upsert as a new table state: insert unseen keys, overwrite seen ones, delete nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.operators import quality, surrogate


class DuplicateKeyError(ValueError):
    """The same key occurs twice in one upsert."""


class MissingKeyError(ValueError):
    """A business key is NULL."""


def require_known(source: DataFrame, keys: list[str]) -> None:
    """Raises when a part of a key is NULL."""
    if not source.filter(reduce(Column.__or__, (F.col(k).isNull() for k in keys))).isEmpty():
        raise MissingKeyError(f"NULL in {', '.join(keys)}")


def require_unique(source: DataFrame, keys: list[str]) -> None:
    """Raises when a key without NULL occurs twice (one pre-aggregated pass over the keys)."""
    duplicates = quality.duplicate_keys(source.select(*keys).dropna(how="any"), keys).take(1)
    if duplicates:
        raise DuplicateKeyError(f"Key {duplicates[0].asDict()} occurs more than once")


def require_keys(source: DataFrame, keys: list[str]) -> None:
    """NOT NULL and UNIQUE: what a primary key demands."""
    require_known(source, keys)
    require_unique(source, keys)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    surrogate_key: str | None = None,
    digits: int = surrogate.LARGE,
    highest: Column | None = None,
) -> DataFrame:
    """State of ``target`` after taking over ``source``; both must be unique on ``keys``, without NULL.

    One full outer join on unique keys, which cannot skew. A surrogate key is kept for a known
    business key; new ones continue after the highest. For them the keys alone, not the rows, are
    compared once more and numbered apart; the numbers then join by the key, as the rows do. Where
    ``target`` is a part of a table, ``highest`` is the highest surrogate key of the whole.
    """
    columns = [c for c in target.columns if c != surrogate_key]
    if surrogate_key:
        unseen = source.select(*keys).join(target.select(*keys), keys, "left_anti")
        if highest is None:
            highest = target.agg(F.max(surrogate_key)).scalar()
        numbered = surrogate.assign(unseen, keys, surrogate_key, digits, highest)
        source = source.join(numbered.withColumnRenamed(surrogate_key, "_new"), keys, "left")
    ours, theirs = target.alias("t"), source.withColumn("_taken", F.lit(True)).alias("s")
    taken = F.col("s._taken").isNotNull()
    merged = [
        F.when(taken, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in columns
    ]
    if surrogate_key:
        merged.append(F.coalesce(F.col(f"t.{surrogate_key}"), F.col("s._new")).alias(surrogate_key))
    same_key = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    return ours.join(theirs, same_key, "full").select(*merged).select(*target.columns)
