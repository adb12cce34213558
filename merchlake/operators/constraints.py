"""NOT NULL and foreign keys, counted by the write itself.

One observation rides along with the write: a count per NOT NULL column and one per foreign key. The
caller makes the written rows readable only after ``check``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class ConstraintError(ValueError):
    """Rows break a constraint of their table."""


@dataclass(frozen=True)
class ForeignKey:
    """``column``, where it is not NULL, must occur in ``reference``, whose column is unique."""

    column: str
    reference: DataFrame
    reference_column: str


@dataclass(frozen=True)
class Guarded:
    """``rows`` to write, ``seen`` the counts of that write, ``check`` raises if a constraint is broken."""

    rows: DataFrame
    seen: Observation
    check: Callable[[], None]


def guard(
    rows: DataFrame, table: str, not_null: Iterable[str], foreign_keys: Iterable[ForeignKey] = (), **more
) -> Guarded:
    """``more`` are further aggregates to observe.

    Foreign keys that the rows' own inner joins guarantee need not be listed: each costs a join.
    """
    seen, foreign_keys = Observation(), list(foreign_keys)
    broken = {f"NULL in {c}": F.count_if(F.col(c).isNull()) for c in not_null}
    flagged = rows
    for number, key in enumerate(foreign_keys):
        ids = key.reference.select(F.col(key.reference_column).alias(f"_id_{number}"))
        flagged = flagged.join(ids, F.col(key.column) == F.col(f"_id_{number}"), "left")
        missing = F.col(key.column).isNotNull() & F.col(f"_id_{number}").isNull()
        broken[f"unknown {key.column}"] = F.count_if(missing)
    counts = [c.alias(f"broken_{k}") for k, c in enumerate(broken.values())]
    observed = flagged.observe(seen, F.count("*").alias("rows"), *counts, *[c.alias(n) for n, c in more.items()])

    def check() -> None:
        found = {name: seen.get[f"broken_{k}"] for k, name in enumerate(broken)}
        wrong = [f"{name} ({n} rows)" for name, n in found.items() if n]
        if wrong:
            raise ConstraintError(f"{table}: {', '.join(wrong)}")

    return Guarded(observed.select(*rows.columns), seen, check)
