"""Metrics of queues and of link checks, and the freshness of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import first_text
from millrace.operators.pool import preferred_url


def queue_metrics(rows: DataFrame) -> DataFrame:
    """A row a queue: rows, companies, links and their coverage (six places)."""
    company = first_text("company_slug", "company_name")
    direct, chosen = first_text("apply_url").isNotNull(), preferred_url().isNotNull()
    out = rows.groupBy("queue").agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(company).alias("company_count"), F.count_if(direct).alias("direct_application_url_count"), F.count_if(chosen).alias("selected_url_count"))
    return out.withColumns(
        {
            "missing_url_count": F.col("row_count") - F.col("selected_url_count"),
            "direct_application_url_coverage": F.round(F.try_divide("direct_application_url_count", "row_count"), 6),
            "selected_url_coverage": F.round(F.try_divide("selected_url_count", "row_count"), 6),
        }
    )


def provider_contribution(rows: DataFrame, queues: list[str]) -> DataFrame:
    """A row a provider: selected rows, share of all, and a column for each queue."""
    provider = F.coalesce(first_text("provider"), F.lit("unknown"))
    by = rows.groupBy(provider.alias("provider")).pivot("queue", queues).agg(F.count(F.lit(1))).na.fill(0, queues)
    counted = by.withColumn("selected_row_count", sum((F.col(f"`{q}`") for q in queues), F.lit(0)))
    total = F.sum("selected_row_count").over(Window.partitionBy())  # over the providers, which are few
    return counted.withColumn("_total", total).withColumn("share_of_selected_rows", F.round(F.try_divide("selected_row_count", "_total"), 6)).drop("_total")


def link_metrics(checks: DataFrame, *by: str) -> DataFrame:
    """Outcomes of link checks (column outcome) by the given columns; dead rate = dead / (live + dead), null without either."""
    outcome = F.coalesce(first_text("outcome"), F.lit("unknown"))
    rows = checks.withColumn("_o", outcome)
    names = ("live", "dead", "blocked", "transient_error", "invalid")
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("validation_row_count"), *[F.count_if(F.col("_o") == n).alias(f"{n}_link_count") for n in names])
    both = F.col("live_link_count") + F.col("dead_link_count")
    return out.withColumn("dead_link_rate", F.round(F.try_divide("dead_link_count", both), 6))


# What a status says of a link.
DEAD, BLOCKED, RETRYABLE = (404, 410), (401, 403, 407, 451), (408, 425, 429, 500, 502, 503, 504)


def classify_status(status):
    """live, dead, blocked, transient_error or unhealthy, of a final HTTP status."""
    return F.when(status.between(200, 299), "live").when(status.isin(*DEAD), "dead").when(status.isin(*BLOCKED), "blocked").when(status.isin(*RETRYABLE) | (status >= 500), "transient_error").otherwise("unhealthy")


def source_freshness(sources: DataFrame, runs: DataFrame, as_of: str, max_age_hours: float = 24.0) -> DataFrame:
    """A row a provider with active complete sources: counts, times of the last attempt and success, and code: null (healthy), never or stale. An age of just the limit is healthy.

    sources: source_id, provider, active, complete. runs: source_id, status, sync_mode, started_at, completed_at. Runs are reduced before the join.
    """
    if max_age_hours <= 0:
        raise ValueError("max_age_hours must be positive")
    good = (F.col("status") == "succeeded") & (F.col("sync_mode") == "complete")
    by_source = runs.groupBy("source_id").agg(F.max("started_at").alias("attempt"), F.max(F.when(good, F.col("completed_at"))).alias("success"), F.count_if(F.col("status") == "running").alias("running"))
    rows = sources.where("active AND complete").join(by_source, "source_id", "left").groupBy("provider").agg(
        F.countDistinct("source_id").alias("active_complete_source_count"),
        F.coalesce(F.sum("running"), F.lit(0)).alias("running_sync_count"),
        F.max("attempt").alias("latest_attempt_at"),
        F.max("success").alias("latest_success_at"),
    )
    age = F.greatest(F.timestamp_diff("SECOND", F.col("latest_success_at"), F.lit(as_of).cast("timestamp")), F.lit(0))
    rows = rows.withColumn("age_seconds", F.when(F.col("latest_success_at").isNotNull(), age))
    code = F.when(F.col("age_seconds").isNull(), "provider_no_successful_complete_sync").when(F.col("age_seconds") > max_age_hours * 3600, "provider_successful_complete_sync_stale")
    return rows.withColumn("code", code)
