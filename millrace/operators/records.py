"""Sources, runs, observations and their companies: filters given or not, run starts, asserted companies, names, values computed once for each key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text

OBSERVATION_DAYS = 45


def filtered(rows: DataFrame, equal: dict[str, object] | None = None, at_least: dict[str, Column] | None = None) -> DataFrame:
    """The rows under those filters that are given: a value of None is no filter. Text is compared in lower case, trimmed on the given side."""
    for name, value in (equal or {}).items():
        if isinstance(value, str):
            rows = rows.where(F.lower(name) == value.strip().lower())
        elif value is not None:
            rows = rows.where(F.col(name) == value)
    for name, value in (at_least or {}).items():
        if value is not None:
            rows = rows.where(F.col(name) >= value)
    return rows


def active_sources(sources: DataFrame, provider: str | None = None, company_id: int | None = None, source_ids: Sequence[int] | None = None, limit: int | None = None) -> DataFrame:
    """Active sources with complete snapshots, by id. No ids at all (an empty list) gives no source."""
    rows = filtered(sources.where("status = 'active' AND sync_mode = 'complete_snapshot'"), {"company_id": company_id})
    if provider is not None:
        rows = rows.where(F.col("provider") == provider)
    if source_ids is not None:
        rows = rows.where(F.col("source_id").isin(*source_ids)) if source_ids else rows.limit(0)
    return rows if limit is None else rows.orderBy("source_id").limit(limit)


def start_runs(requests: DataFrame, sources: DataFrame, runs: DataFrame) -> DataFrame:
    """requests (source_id, run_key, provider) with ``action``: start, replay (the key's run is completed), or what forbids it. The first that holds decides.

    sources: source_id, provider, status, sync_mode. runs: source_id, run_key, status; (source_id, run_key) is unique, as is source_id in sources.
    """
    about = sources.select("source_id", F.col("provider").alias("_provider"), F.col("status").alias("_status"), F.col("sync_mode").alias("_mode"))
    rows = requests.join(about, "source_id", "left").join(runs.select("source_id", "run_key", F.col("status").alias("_run")), ["source_id", "run_key"], "left")
    action = (
        F.when(F.col("_provider").isNull(), "unknown_source")
        .when(F.col("_provider") != F.col("provider"), "provider_differs")
        .when(F.col("_status") != "active", "source_disabled")
        .when(F.col("_mode") != "complete_snapshot", "not_a_snapshot_source")
        .when(F.col("_run") == "completed", "replay")
        .when(F.col("_run").isNotNull(), "run_key_reused")
        .otherwise("start")
    )
    return rows.select(*requests.columns, action.alias("action"))


def asserted_companies(observed: DataFrame, keys: Sequence[str], company: str) -> DataFrame:
    """keys, company_ids (sorted), ambiguous: the companies that observations assert for one work item; what is not a number does not count, several are ambiguous."""
    ids = F.array_sort(F.collect_set(text.safe_int(F.col(company))))
    return observed.groupBy(*keys).agg(ids.alias("company_ids")).withColumn("ambiguous", F.size("company_ids") > 1)


def confirmed_names(rows: DataFrame, keys: Sequence[str], name: str, order: str) -> DataFrame:
    """keys, confirmed_name: the one name that all rows agree on but for case, as it was first written (by ``order``); null where they do not agree."""
    own = rows.withColumn("_n", F.nullif(F.trim(name), F.lit(""))).where("_n IS NOT NULL")
    folded = F.lower("_n")
    agreed = own.groupBy(*keys).agg(F.min(folded).alias("_low"), F.max(folded).alias("_high"), F.min_by("_n", order).alias("_first"))
    return agreed.select(*keys, F.when(F.col("_low") == F.col("_high"), F.col("_first")).alias("confirmed_name"))


def computed_once(rows: DataFrame, key: Column, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows with what ``compute`` adds to the distinct keys (a table with the column key). Rows without a key get nulls."""
    keyed = rows.withColumn("key", key)
    return keyed.join(compute(keyed.where("key IS NOT NULL").select("key").distinct()), "key", "left")


def recently_observed(as_of: Column, source_times: Sequence[Column], other_times: Sequence[Column], days: int = OBSERVATION_DAYS) -> Column:
    """Whether the latest time from the source, or without one the latest of the others, is at most ``days`` old and at most a day ahead."""

    def latest(times):
        return F.greatest(*times) if len(times) > 1 else times[0]

    at = F.coalesce(latest(list(source_times)), latest(list(other_times)))
    seconds = F.timestamp_diff("SECOND", at, as_of)
    return F.coalesce(seconds.between(-86400, days * 86400), F.lit(False))


def pool_summary(classified: DataFrame, most: int) -> DataFrame:
    """metric, value, n of a classified pool (``pool.classify``) whose lanes take ``most`` rows each: counts of lanes and queues, and distributions.

    needs lane_rank (``pool.top_per_lane`` over all rows, or null beyond the limit). One pass: each row gives the metrics that it counts in.
    """
    lane, chosen = F.col("application_lane"), F.col("lane_rank") <= most
    chosen = chosen & lane.isin("application", "verification")

    def value(name):
        return F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit("unknown"))

    def metric(name, what, when=F.lit(True)):
        return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(name).alias("metric"), what.alias("value")))

    none = F.lit(None).cast("string")
    counted = F.array(
        metric("inventory_count", none),
        metric("application_candidate_count", none, lane == "application"),
        metric("verification_candidate_count", none, lane == "verification"),
        metric("application_queue_count", none, chosen & (lane == "application")),
        metric("verification_queue_count", none, chosen & (lane == "verification")),
        metric("excluded_count", none, lane == "excluded"),
        metric("provider_contribution", value("provider"), chosen),
        metric("application_provider_contribution", value("provider"), chosen & (lane == "application")),
        metric("verification_provider_contribution", value("provider"), chosen & (lane == "verification")),
        metric("remote_status_distribution", value("remote_eligibility_status")),
        metric("role_status_distribution", value("role_match_status")),
        metric("freshness_distribution", value("freshness_band"), chosen),
        metric("exclusion_reason_distribution", value("application_lane_reason"), lane == "excluded"),
    )
    return classified.select(F.explode(F.array_compact(counted)).alias("m")).groupBy("m.metric", "m.value").agg(F.count(F.lit(1)).alias("n"))
