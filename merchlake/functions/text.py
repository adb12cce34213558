"""String helpers with Unicode-aware whitespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE_SPACE = r"(?U)^\s+|\s+$"
_ANY_SPACE = r"(?U)\s"


def strip(column: Column) -> Column:
    """Drop leading and trailing whitespace of any kind; NULL stays NULL, blank becomes ''."""
    return F.regexp_replace(column, _EDGE_SPACE, "")


def strip_lower(column: Column) -> Column:
    return F.lower(strip(column))


def is_blank(column: Column) -> Column:
    """True for '' and whitespace-only text, NULL for NULL."""
    return F.regexp_replace(column, _ANY_SPACE, "") == ""
