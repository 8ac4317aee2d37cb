"""Imports and promotions: states of a run's work, candidates whose job exists, dependants of a source, summaries, rows that are shown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_states(observations: DataFrame, work: DataFrame) -> DataFrame:
    """run_id, state, n: distinct work items that a run's observations link to, by state. observations: run_id, work_id. work: work_id, state."""
    linked = observations.select("run_id", "work_id").where("work_id IS NOT NULL").distinct()
    return linked.join(work.select("work_id", "state"), "work_id").groupBy("run_id", "state").agg(F.count(F.lit(1)).alias("n"))


def mark_promoted(candidates: DataFrame, jobs: DataFrame, leased: Column) -> DataFrame:
    """The candidates, where those under the lease that have a job are promoted and carry its id; the others stay as they are.

    Both have company_source_id and external_job_id, which are unique in jobs (with job_id); candidates have status and promoted_job_id too.
    """
    known = jobs.select("company_source_id", "external_job_id", F.col("job_id").alias("_job"))
    rows = candidates.join(known, ["company_source_id", "external_job_id"], "left")
    found = leased & F.col("_job").isNotNull()
    changed = {"status": F.when(found, "promoted").otherwise(F.col("status")), "promoted_job_id": F.when(found, F.col("_job")).otherwise(F.col("promoted_job_id"))}
    return rows.withColumns(changed).select(*candidates.columns)


def source_dependants(sources: DataFrame, jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """source_id, jobs, sync_runs: how many rows depend on each source; each table is counted before it is joined."""

    def counted(rows, name):
        return rows.groupBy("source_id").agg(F.count(F.lit(1)).alias(name))

    out = sources.select("source_id").join(counted(jobs, "jobs"), "source_id", "left").join(counted(runs, "sync_runs"), "source_id", "left")
    return out.fillna(0, ["jobs", "sync_runs"])


def import_summary(resolutions: DataFrame) -> DataFrame:
    """companies_resolved, companies_created, provisional_companies of resolutions (company_id, company_created, identity_state): one row a company first, then sums."""
    by = resolutions.where("company_id IS NOT NULL").groupBy("company_id").agg(F.max("company_created").alias("created"), F.max(F.col("identity_state") == "provisional").alias("provisional"))
    return by.agg(F.count(F.lit(1)).alias("companies_resolved"), F.count_if("created").alias("companies_created"), F.count_if("provisional").alias("provisional_companies"))


def display_rows(jobs: DataFrame, columns: Sequence[str], linked: DataFrame | None = None) -> DataFrame:
    """Columns of active jobs. Of all sources, repeated rows stay; of a run's linked sources (source_id, in any number), each row comes once."""
    active = jobs.where("status = 'active'")
    if linked is None:
        return active.select(*columns)
    return active.join(linked.select("source_id"), "source_id", "left_semi").select(*columns).distinct()


def matching(jobs: DataFrame, role: Column, remote: Column, roles: Sequence[str], remotes: Sequence[str], title_gate: Column | None = None, order: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Jobs whose title passes the gate, then whose role, then whose remote status is wanted; costly columns are thus computed for what is left. The limit comes last; 0 gives no row."""
    rows = jobs if title_gate is None else jobs.where(title_gate)
    rows = rows.withColumn("role_match_status", role).where(F.col("role_match_status").isin(*roles))
    rows = rows.withColumn("remote_eligibility_status", remote).where(F.col("remote_eligibility_status").isin(*remotes))
    return rows if limit is None else rows.orderBy(*order).limit(limit)
