"""Row numbers over a total order, without a window that takes all rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.versions import cut


def numbered(rows: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """The rows with their number from 1 on in ``order`` (which no two rows should share): dealt by range, numbered in each range, and moved by what the ranges before hold.

    The driver gets one count for each range.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of a row in its partition is in the lower 33 bits, that of the partition above.
    table = cut(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_at", 33)
    counts = table.groupBy(part.alias("part")).count().collect()
    offsets, before = [], 0
    for p, n in sorted(map(tuple, counts)):
        offsets += [F.lit(p).cast("long"), F.lit(before).cast("long")]
        before += n
    if not offsets:
        return table.withColumn(name, F.col("_at")).drop("_at")
    start = F.element_at(F.create_map(*offsets), part)
    return table.withColumn(name, start + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at")


def numbered_within(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """The rows with their number from 1 on inside their key. A key that very many rows have is spread over ranges like all others."""
    whole = cut(numbered(rows, [*map(F.col, keys), *order], "_n"), "numbered")
    first = whole.groupBy(*keys).agg(F.min("_n").alias("_first"))
    joined = whole.alias("w").join(first.alias("f"), [F.col(f"w.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys])
    return joined.select("w.*", (F.col("_n") - F.col("_first") + 1).alias(name)).drop("_n")
