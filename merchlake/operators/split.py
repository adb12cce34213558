"""Keep-first uniqueness and the exact valid / rejected split.

"First" needs an order that does not depend on how files were read: rows of one key are ranked
by all their other columns. Rows equal in every column are interchangeable.

One key (often NULL) may own a large share of the rows, so no step sends a whole key group to
one task:

* the valid side keeps rank 1 only. Spark then ranks inside every input partition first and
  shuffles at most one row per key and partition;
* the rejected side ranks only rows whose key occurs again. It ranks per (key, input partition),
  then ranks the partition winners of a key against each other, and spreads the losers by
  partition. Rows that break a rule are rejected without any ranking.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.operators import quality, rules

# Unknown references up to which rows are sorted out by value instead of by a join.
FEW_UNKNOWN = 1000


@dataclass(frozen=True)
class Membership:
    """Column whose values must occur in a reference column of another table."""

    column: str
    reference: DataFrame
    reference_column: str


def _rank_order(df: DataFrame, key: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in df.columns if c != key and not c.startswith("_")]


def with_slice(df: DataFrame) -> DataFrame:
    """Adds the number of the input partition; a retried task sees the same partition."""
    return df.withColumn("_slice", F.spark_partition_id())


def flag_first(df: DataFrame, key: str, flag: str = "_first") -> DataFrame:
    """Adds ``flag``: true on exactly one row per key value (NULL is a value too).

    Slices must be cut before rows of a key are brought together, so a caller that shuffles by
    the key first adds them with ``with_slice``.
    """
    order = _rank_order(df, key)
    sliced = df if "_slice" in df.columns else with_slice(df)
    ranked = sliced.withColumn(
        "_local", F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order))
    )
    finalists = F.when(F.col("_local") > 1, F.col("_slice")).otherwise(F.lit(-1))
    ranked = ranked.withColumn("_group", finalists).withColumn(
        "_global", F.row_number().over(Window.partitionBy(key, "_group").orderBy(*order))
    )
    return ranked.withColumn(
        flag, (F.col("_local") == 1) & (F.col("_global") == 1)
    ).drop("_slice", "_local", "_group", "_global")


@dataclass(frozen=True)
class Split:
    """A batch with its rules; both sides are lazy and together give back the batch."""

    batch: DataFrame
    key: str
    row_rules: tuple[Column, ...]
    memberships: tuple[Membership, ...] = ()

    @cached_property
    def valid(self) -> DataFrame:
        rank = F.row_number().over(
            Window.partitionBy(self.key).orderBy(*_rank_order(self.batch, self.key))
        )
        kept = self.batch.withColumn("_rank", rank).filter(
            (F.col("_rank") == 1) & rules.all_of(self.row_rules)
        )
        return self._with_known_members(kept).select(*self.batch.columns)

    @property
    def rejected(self) -> DataFrame:
        return self._breaking_a_rule().unionByName(self._not_first())

    def _breaking_a_rule(self) -> DataFrame:
        df, passed = self.batch, list(self.row_rules)
        for number, member in enumerate(self.memberships):
            flag = f"_member_{number}"
            df = rules.add_member_flag(
                df, member.column, member.reference, member.reference_column, flag
            )
            passed.append(F.col(flag))
        return df.filter(~rules.all_of(passed)).select(*self.batch.columns)

    def _not_first(self) -> DataFrame:
        """Rows that pass every rule but the uniqueness of their key."""
        repeated = (
            self.batch.groupBy(F.col(self.key).alias("_key"))
            .agg(F.count("*").alias("_rows"))
            .filter("_rows > 1")
        )
        again = with_slice(self.batch).join(
            repeated, F.col(self.key).eqNullSafe(F.col("_key")), "left_semi"
        )
        later = flag_first(again, self.key).filter(
            ~F.col("_first") & rules.all_of(self.row_rules)
        )
        return self._with_known_members(later).select(*self.batch.columns)

    def _with_known_members(self, df: DataFrame) -> DataFrame:
        for member, unknown in zip(self.memberships, self._unknown, strict=True):
            column = F.col(member.column)
            if unknown is not None:
                df = df.filter(column.isNotNull() & ~column.isin(unknown))
                continue
            ids = member.reference.select(
                F.col(member.reference_column).alias("_ref_id")
            ).distinct()
            df = df.join(ids, column == F.col("_ref_id"), "left_semi")
        return df

    @cached_property
    def _unknown(self) -> list[list | None]:
        """Per membership the values of the batch that its reference lacks; None when they are many.

        References nearly always exist. The keys alone are compared to find the few that do not, so
        the rows need not be shuffled by each of their references.
        """
        found = []
        for member in self.memberships:
            missing = quality.orphans(
                self.batch.select(member.column).distinct(),
                member.column,
                member.reference,
                member.reference_column,
            )
            few = missing.limit(FEW_UNKNOWN + 1).collect()
            found.append([r[0] for r in few] if len(few) <= FEW_UNKNOWN else None)
        return found

    @property
    def counts(self) -> DataFrame:
        """One row: rows extracted, loaded and rejected."""
        sides = self.batch.select(F.lit(0).alias("_loaded")).unionByName(
            self.valid.select(F.lit(1).alias("_loaded"))
        )
        extracted, loaded = F.count_if(F.col("_loaded") == 0), F.count_if(F.col("_loaded") == 1)
        return sides.agg(
            extracted.alias("rows_extracted"),
            loaded.alias("rows_loaded"),
            (extracted - loaded).alias("rows_rejected"),
        )


def split(
    batch: DataFrame, key: str, *row_rules: Column, members: Iterable[Membership] = ()
) -> Split:
    return Split(batch, key, tuple(row_rules), tuple(members))
