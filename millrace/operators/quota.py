"""Quotas: largest remainder, and greedy selection under quotas and a cap per company."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def largest_remainder(weights: DataFrame, name: str, weight: str, seats: int) -> DataFrame:
    """name, quota: ``seats`` shared in proportion to whole-number weights; what is left goes to the largest remainders, ties by name. ``weights`` has a row a stratum, a small table."""
    everything = Window.partitionBy()
    total = F.sum(weight).over(everything)
    exact = weights.select(name, (F.col(weight) * seats).alias("_share"), total.alias("_total"))
    parts = exact.select(name, F.expr("_share div _total").alias("_floor"), F.pmod("_share", "_total").alias("_rest"))
    left = F.lit(seats) - F.sum("_floor").over(everything)
    place = F.row_number().over(everything.orderBy(F.col("_rest").desc(), F.col(name)))
    return parts.select(name, (F.col("_floor") + F.when(place <= left, 1).otherwise(0)).cast("long").alias("quota"))


def greedy(candidates: DataFrame, quotas: DataFrame, stratum: str, company: str, order: list, most_per_company: int) -> DataFrame:
    """The candidates taken, with ``taken_rank``: strata fill their quotas in order of their names, best candidate first, no company over its cap across all strata.

    What a stratum may take depends on what those before it took, so it is sequential by meaning. It stays small: no stratum can
    need more than its quota from any one company, nor more than the cap, so each (stratum, company) sends its best min(quota, cap)
    and each stratum its best few of those; that much is what the one sequential step sees.
    """
    best = F.row_number().over(Window.partitionBy(stratum, company).orderBy(*order))
    few = candidates.withColumn("_in_company", best).where(F.col("_in_company") <= most_per_company)
    few = few.join(quotas, stratum)
    place = F.row_number().over(Window.partitionBy(stratum).orderBy(*order))
    # Companies that earlier strata filled can block at most total / cap companies, each with cap rows here.
    total = quotas.agg(F.sum("quota").alias("total"))
    few = few.withColumn("_place", place).join(F.broadcast(total), how="cross").where(F.col("_place") <= F.col("quota") + F.col("total")).drop("total")

    def take(rows: pd.DataFrame) -> pd.DataFrame:
        held: dict = {}
        kept = []
        for _, group in rows.sort_values([stratum, "_place"]).groupby(stratum, sort=True):
            n, quota = 0, int(group["quota"].iloc[0])
            for i, c in zip(group.index, group[company]):
                if n < quota and held.get(c, 0) < most_per_company:
                    held[c] = held.get(c, 0) + 1
                    n += 1
                    kept.append(i)
        out = rows.loc[kept].drop(columns=["_in_company", "_place", "quota"])
        out["taken_rank"] = range(1, len(out) + 1)
        return out

    schema = ", ".join(f"{n} {t}" for n, t in candidates.dtypes) + ", taken_rank int"
    names = list(candidates.columns)
    few = few.select(*names, "_in_company", "_place", "quota", F.lit(0).alias("_all"))
    return few.groupBy("_all").applyInPandas(lambda rows: take(rows)[[*names, "taken_rank"]], schema)
