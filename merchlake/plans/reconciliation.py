"""Gate between facts and marts: staged volumes and amounts must reappear in the facts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.functions import numeric

_VALUE = "decimal(38,2)"

# Check names in report order; per check the staged table and column, the fact
# table and column. A NULL column counts rows.
CHECKS = [
    ("volume_sessions", "website_sessions", None, "fact_sessions", None),
    ("volume_pages_vues", "website_pageviews", None, "fact_sessions", "pageview_count"),
    ("volume_commandes", "orders", None, "fact_sessions", "order_count"),
    ("volume_articles", "order_items", None, "fact_sales", None),
    ("ventes_articles", "order_items", "price_usd", "fact_sales", "price_usd"),
    ("marge_articles", "order_items", "gross_profit", "fact_sales", "gross_profit_usd"),
    ("remboursements", "order_item_refunds", "refund_amount_usd", "fact_sales", "refund_amount_usd"),
    ("ventes_sessions", "orders", "price_usd", "fact_sessions", "revenue_usd"),
    ("marge_sessions", "orders", "gross_profit", "fact_sessions", "gross_profit_usd"),
]


class ReconciliationError(RuntimeError):
    """Staging and warehouse disagree."""


@dataclass(frozen=True)
class Check:
    name: str
    expected: Decimal
    actual: Decimal

    @property
    def passed(self) -> bool:
        return self.expected == self.actual

    def __str__(self) -> str:
        return f"{self.name}: attendu={_plain(self.expected)}, obtenu={_plain(self.actual)}"


def _plain(value: Decimal) -> str:
    return str(int(value)) if value == value.to_integral_value() else str(value)


def _measure(column: str | None) -> Column:
    if column is None:
        return F.count("*").cast(_VALUE)
    total = F.sum(numeric.exact(F.col(column)))
    return F.round(F.coalesce(total, F.lit(0)), 2).cast(_VALUE)


def _measures(table: DataFrame, wanted: list[tuple[str, str | None]]) -> DataFrame:
    """All measures of one table in one pass, as (name, value) rows."""
    totals = table.agg(*[_measure(column).alias(name) for name, column in wanted])
    pairs = [F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n, _ in wanted]
    return totals.select(F.inline(F.array(*pairs)))


def reconcile(staged: Mapping[str, DataFrame], facts: Mapping[str, DataFrame]) -> DataFrame:
    """Nine rows (name, expected, actual, passed); each of the seven tables is read once."""
    parts = []
    for side, tables, table_at, column_at in (
        ("expected", staged, 1, 2),
        ("actual", facts, 3, 4),
    ):
        for table in dict.fromkeys(check[table_at] for check in CHECKS):
            wanted = [(c[0], c[column_at]) for c in CHECKS if c[table_at] == table]
            rows = _measures(tables[table], wanted)
            parts.append(rows.select("name", F.lit(side).alias("side"), "value"))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("name")
        .agg(
            F.max(F.when(F.col("side") == "expected", F.col("value"))).alias("expected"),
            F.max(F.when(F.col("side") == "actual", F.col("value"))).alias("actual"),
        )
        .withColumn("passed", F.col("expected") == F.col("actual"))
    )


def require_reconciled(report: DataFrame) -> list[Check]:
    """Collects the nine rows; raises when one of them fails."""
    found = {r["name"]: Check(r["name"], r["expected"], r["actual"]) for r in report.collect()}
    checks = [found[name] for name, *_ in CHECKS]
    failures = "; ".join(str(check) for check in checks if not check.passed)
    if failures:
        raise ReconciliationError(f"Réconciliation du warehouse échouée : {failures}")
    return checks
