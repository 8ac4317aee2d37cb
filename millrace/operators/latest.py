"""Latest row per key, and tables with the latest row of another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order`` (end it with a unique column). One aggregation with map-side combining; no sort, so a hot key costs one row a task."""
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def with_latest(left: DataFrame, rows: DataFrame, left_key: str, right_key: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left join of each row with the latest of its others; the others are reduced before the join."""
    last = latest_per_key(rows, [right_key], order, values)
    return left.join(last, left[left_key] == last[right_key], "left").drop(last[right_key])
