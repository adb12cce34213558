"""Exact money sums and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for the data, narrow enough that Spark keeps at least 18 fractional digits in a
# quotient: rounding such a quotient once more never moves a result.
_COUNT = "decimal(15,0)"
_AMOUNT = "decimal(18,2)"
# Source money is floating point. Six fractional digits absorb the binary noise and fit in a
# long, so sums are exact and do not depend on the order in which partitions arrive.
_EXACT = "decimal(18,6)"


def exact(amount: Column) -> Column:
    return amount.cast(_EXACT)


def exact_sum(amount: Column, result: str) -> Column:
    return F.sum(exact(amount)).cast(result)


def zero_if_null(column: Column, result: str | None = None) -> Column:
    value = F.coalesce(column, F.lit(0))
    return value.cast(result) if result else value


def ratio(numerator: Column, denominator: Column, result: str) -> Column:
    """``numerator / denominator`` rounded half up to ``result``; 0 when the divisor is 0."""
    return zero_if_null(numerator / F.nullif(denominator, F.lit(0).cast(_COUNT)), result)


def count_rate(part: Column, whole: Column, result: str) -> Column:
    return ratio(part.cast(_COUNT), whole.cast(_COUNT), result)


def per_count(amount: Column, count: Column, result: str) -> Column:
    return ratio(amount.cast(_AMOUNT), count.cast(_COUNT), result)


def amount_rate(part: Column, whole: Column, result: str) -> Column:
    return ratio(part.cast(_AMOUNT), whole.cast(_AMOUNT), result)


def plain_ratio(numerator: Column, denominator: Column) -> Column:
    """Floating-point ratio, 0.0 when the divisor is 0 (analysis tables)."""
    return F.coalesce(
        numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0)), F.lit(0.0)
    )
