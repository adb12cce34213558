"""From source batches to staged tables: validate, then normalise, in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from merchlake.operators import validators
from merchlake.operators.split import Split
from merchlake.operators.transforms import TRANSFORMS
from merchlake.plans.lazy import LazyTables, mapped

Tables = Mapping[str, DataFrame]


# Sources of one layer are independent; a layer refers to the ones before it.
STAGING_LAYERS = [
    ["website_sessions", "website_pageviews", "products", "orders"],
    ["order_items"],
    ["order_item_refunds"],
]


def split_of(name: str, raw: Tables, known: Tables) -> Split:
    """Valid and rejected rows of one source.

    ``known`` holds what references may point to: all staged orders, and this run's valid
    products and items.
    """
    rows = raw[name]
    if name == "order_items":
        return validators.validate_order_items(rows, known["orders"], known["products"])
    if name == "order_item_refunds":
        return validators.validate_refunds(rows, known["order_items"], known["orders"])
    simple = {
        "website_sessions": validators.validate_sessions,
        "website_pageviews": validators.validate_pageviews,
        "products": validators.validate_products,
        "orders": validators.validate_orders,
    }
    return simple[name](rows)


def transform_all(valid: Tables) -> LazyTables:
    return mapped(valid, lambda name, rows: TRANSFORMS[name](rows))


def stage(raw: Tables, settle: Callable[[str, DataFrame], DataFrame]) -> LazyTables:
    """Staged tables. ``settle`` writes one and reads it back, so that later sources refer to
    written ids instead of validating the earlier sources again."""
    staged = LazyTables(
        {
            name: (lambda n=name: settle(n, TRANSFORMS[n](split_of(n, raw, staged).valid)))
            for name in raw
        }
    )
    return staged
