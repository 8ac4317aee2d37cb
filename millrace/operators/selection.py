"""Selection of rows that are paid for: strata fill their quotas with one row a company, then the budget is filled at two a company, then without a cap; what comes next is the reserve.

What a row may do depends on those chosen before it, so the choice itself is sequential by meaning. It sees a number of rows that the budget and the reserve bound, whatever the table's size: a row
is passed over only because it or its company was chosen before, or for the cap on staff rows, and each of these can happen to so many rows only. So the best few of each stratum (one of a company,
staff and others apart), of the companies (three each) and of all rows are enough. Each of those lists is a sorted limit, made in Spark.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Share of staff rows in the budget.
STAFF_SHARE = 0.15
RESULT = "job_id long, kind string, place int, stratum string"


def candidates(previews: DataFrame, excluded: DataFrame | None = None, forbidden_title: str | None = None) -> DataFrame:
    """job_id, company, staff, score, posted_at and strata (sorted): one row for each job that comes into question, with its best preview and all strata that brought it.

    previews: stratum, job_id, title, company, hybrid, employment (list), seniority, role_status, score, posted_at. A job needs an id, a title and a company, must not be hybrid nor anything but full time, nor have a
    ``forbidden_title`` (a regular expression), nor be of an excluded role; a weak role needs a seniority of the middle or above.
    """
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    seniority = F.lower(F.trim(F.coalesce("seniority", F.lit(""))))
    kinds = F.transform(F.coalesce("employment", F.array().cast("array<string>")), F.lower)
    bad = F.col("job_id").isNull() | blank("title") | blank("company") | F.coalesce("hybrid", F.lit(False)) | F.exists(kinds, lambda k: k != "full_time")
    bad = bad | (F.col("role_status") == "exclude") | ((F.col("role_status") == "weak") & ~seniority.isin("mid_level", "senior", "staff"))
    rows = previews.where(~F.coalesce(bad, F.lit(True)))
    if forbidden_title:
        rows = rows.where(~F.col("title").rlike(f"(?i){forbidden_title}"))
    if excluded is not None:
        rows = rows.join(excluded.select("job_id").distinct(), "job_id", "left_anti")
    staff = seniority == "staff"
    best = F.max_by(F.struct(F.trim("company").alias("company"), staff.alias("staff"), "score", "posted_at"), F.struct("score", "posted_at", "company", staff))
    return rows.groupBy("job_id").agg(best.alias("b"), F.array_sort(F.collect_set("stratum")).alias("strata")).select("job_id", "b.*", "strata")


def order() -> list[Column]:
    """Best score first, then the latest, then the smallest id."""
    return [F.desc("score"), F.desc_nulls_last("posted_at"), F.asc("job_id")]


def shortlist(rows: DataFrame, quotas: dict[str, int], budget: int, reserve: int) -> DataFrame:
    """All rows that the choice can look at with effect, and maybe more."""
    parts = []
    for staff in (False, True):
        own = rows.where(F.col("staff") == staff)
        for stratum, quota in quotas.items():
            inside = own.where(F.array_contains("strata", stratum))
            first = F.row_number().over(Window.partitionBy("company").orderBy(*order()))
            parts.append(inside.withColumn("_k", first).where("_k = 1").drop("_k").orderBy(*order()).limit(quota + 2 * budget))
        first = F.row_number().over(Window.partitionBy("company").orderBy(*order()))
        parts.append(own.withColumn("_k", first).where("_k <= 3").drop("_k").orderBy(*order()).limit(6 * (budget + reserve)))
        parts.append(own.orderBy(*order()).limit(3 * (budget + reserve)))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.dropDuplicates(["job_id"])


def choose(rows: list[dict], quotas: dict[str, int], budget: int, reserve: int) -> list[tuple[int, str, int, str | None]]:
    """The choice over rows in their order: (job_id, kind, place, stratum)."""
    most_staff, staff = max(1, int(budget * STAFF_SHARE)), 0
    of_company, of_stratum, chosen = Counter(), Counter(), {}

    def take(row, stratum, cap) -> None:
        nonlocal staff
        if row["job_id"] in chosen or (cap and of_company[row["company"]] >= cap) or (row["staff"] and staff >= most_staff):
            return
        chosen[row["job_id"]] = stratum
        of_company[row["company"]] += 1
        of_stratum[stratum] += 1
        staff += row["staff"]

    for stratum, quota in quotas.items():
        for row in rows:
            if of_stratum[stratum] >= quota or len(chosen) >= budget:
                break
            if stratum in row["strata"]:
                take(row, stratum, 1)
    for cap in (2, None):
        for row in rows:
            if len(chosen) >= budget:
                break
            take(row, min(row["strata"], key=lambda s: (of_stratum[s] - quotas.get(s, 0), s)), cap)
    kept: dict[int, None] = {}
    for cap in (2, None):
        for row in rows:
            if len(kept) >= reserve:
                break
            if row["job_id"] not in chosen and row["job_id"] not in kept and not (cap and of_company[row["company"]] >= cap):
                kept[row["job_id"]] = None
                of_company[row["company"]] += 1
    return [(j, "selected", k, s) for k, (j, s) in enumerate(chosen.items(), 1)] + [(j, "reserve", k, None) for k, j in enumerate(kept, 1)]


def select(rows: DataFrame, quotas: dict[str, int], budget: int, reserve: int) -> DataFrame:
    """RESULT: the jobs of ``candidates`` that are chosen, and the reserve, in the order in which they were taken. ``quotas`` in the order of the strata."""

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["score", "_late", "job_id"], ascending=[False, False, True])
        found = choose(frame.to_dict("records"), quotas, budget, reserve)
        return pd.DataFrame(found, columns=["job_id", "kind", "place", "stratum"])

    few = shortlist(rows, quotas, budget, reserve).withColumn("_late", F.coalesce(F.unix_micros(F.col("posted_at").cast("timestamp")), F.lit(-(1 << 62)).cast("long")))
    return few.drop("posted_at").withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(lambda f: each(f), RESULT)
