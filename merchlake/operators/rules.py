"""Row rules as boolean columns. Every rule is true or false, never NULL."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.functions import text


def _settled(condition: Column, otherwise: bool = False) -> Column:
    return F.coalesce(condition, F.lit(otherwise))


def _number(column: str) -> Column:
    # NaN stands for a missing number; Spark would rank it above every other value.
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def number_not_null(column: str) -> Column:
    return _number(column).isNotNull()


def is_non_negative(column: str) -> Column:
    return _settled(_number(column) >= 0)


def is_positive(column: str) -> Column:
    return _settled(_number(column) > 0)


def is_in_set(column: str, allowed: Iterable) -> Column:
    return _settled(F.col(column).isin(list(allowed)))


def not_empty_string(column: str) -> Column:
    """Rejects blank text only: a missing value passes, as in the source system."""
    return _settled(~text.is_blank(F.col(column)), otherwise=True)


def all_of(rules: Iterable[Column]) -> Column:
    return reduce(and_, rules, F.lit(True))


def add_member_flag(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str, flag: str
) -> DataFrame:
    """Adds ``flag``: whether the value occurs in the reference column (NULL does not).

    The reference is reduced to distinct ids and joined; it never reaches the driver. Spark
    broadcasts it when it measures small, else both sides shuffle and skewed ids are split.
    """
    ids = (
        reference.select(F.col(reference_column).alias("_ref_id"))
        .filter("_ref_id IS NOT NULL")
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    joined = df.join(ids, F.col(column) == F.col("_ref_id"), "left").drop("_ref_id")
    return joined.withColumn(flag, _settled(F.col(flag)))
