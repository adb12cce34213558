"""Quarantine of rejected rows."""

from __future__ import annotations

import re
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Fixed value: names that may become part of a path.
SAFE_NAME = re.compile(r"[A-Za-z0-9_-]+")


def require_safe_name(value: str, field: str) -> None:
    if not value or SAFE_NAME.fullmatch(value) is None:
        raise ValueError(f"Invalid {field} for quarantine: {value!r}")


def mark_rejected(rejected: DataFrame, run_id: str, rejected_at: datetime) -> DataFrame:
    return rejected.withColumns(
        {"_pipeline_run_id": F.lit(run_id), "_rejected_at": F.lit(rejected_at.isoformat())}
    )


def quarantine(
    rejected: DataFrame, source: str, run_id: str, folder: str, replace: bool = False
) -> int:
    """Adds the rows under ``source=…/run_id=…`` as CSV and returns their number.

    Partition folders appear only for rows that exist, so an empty batch leaves nothing. With
    ``replace`` a repeated call with the same names replaces what the first one wrote.
    """
    require_safe_name(source, "source")
    require_safe_name(run_id, "run_id")
    seen = Observation()
    (
        mark_rejected(rejected, run_id, datetime.now(UTC))
        .observe(seen, F.count("*").alias("rows"))
        .withColumns({"source": F.lit(source), "run_id": F.lit(run_id)})
        .write.mode("overwrite" if replace else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("source", "run_id")
        .csv(folder)
    )
    return seen.get["rows"]
