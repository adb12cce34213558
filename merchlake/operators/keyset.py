"""Keyset checkpoints: position (created_at, order_id) in the order stream."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Watermark:
    """Last position taken over; both parts are set or neither is."""

    last_created_at: datetime | None = None
    last_id: int | None = None

    def __post_init__(self) -> None:
        if (self.last_created_at is None) != (self.last_id is None):
            raise ValueError("Half a position: created_after and after_id must be provided together")

    @property
    def is_empty(self) -> bool:
        return self.last_id is None


EMPTY = Watermark()


def naive_utc(moment: datetime) -> datetime:
    return moment.astimezone(UTC).replace(tzinfo=None) if moment.tzinfo else moment


def _position(watermark: Watermark) -> tuple[Column, Column]:
    moment = naive_utc(watermark.last_created_at)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz"), F.lit(watermark.last_id)


def after(orders: DataFrame, watermark: Watermark = EMPTY) -> DataFrame:
    """Orders strictly behind the checkpoint, in (created_at, order_id) order.

    The first conjunct repeats what the second implies, in the form a Parquet scan can use to
    skip row groups.
    """
    if watermark.is_empty:
        return orders
    moment, last_id = _position(watermark)
    created, key = F.col("created_at"), F.col("order_id")
    return orders.filter(created >= moment).filter(
        (created > moment) | ((created == moment) & (key > last_id))
    )


def late(orders: DataFrame, staged: DataFrame, watermark: Watermark) -> DataFrame:
    """Source orders at or before the checkpoint that were never staged (diagnostic).

    The keyset filter will not read them again.
    """
    moment, last_id = _position(watermark)
    created, key = F.col("created_at"), F.col("order_id")
    return (
        orders.filter(created <= moment)
        .filter((created < moment) | (key <= last_id))
        .join(staged.select("order_id"), "order_id", "left_anti")
    )


def checkpoint(orders: DataFrame) -> DataFrame:
    """One row with the highest position; an aggregate, not a sort."""
    top = F.max(F.struct("created_at", "order_id"))
    return orders.agg(top.alias("_top")).select(
        F.col("_top.created_at").alias("last_created_at"),
        F.col("_top.order_id").alias("last_id"),
    )
