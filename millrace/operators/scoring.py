"""Opportunity scores of companies from their classified, clustered postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.pool import points
from millrace.operators.ranks import numbered

# Fixed values of the scores.
ROLE_STATUS_SCORE_ADJUSTMENTS = {"strong": 16, "possible": 7, "weak": -6, "exclude": -30}
OBSERVATION_OPPORTUNITY_SCORE_CAP = 64
OBSERVATION_FRESHNESS_DAYS = 45
OBSERVATION_ROLE_SCORES = {"strong": 36, "possible": 22}
OBSERVATION_REMOTE_SCORE_ADJUSTMENTS = {
    "pakistan_explicit": 18,
    "global_explicit": 16,
    "regional_unconfirmed": 2,
    "remote_unclear": 0,
    "restricted_remote": -14,
    "onsite_explicit": -18,
    "no_remote_evidence": -4,
}
MANAGED_ROLE_SCORES = {"strong": 70, "possible": 40, "exclude": -30}
MANAGED_REMOTE_SCORES = {"pakistan_explicit": 30, "global_explicit": 28, "regional_unconfirmed": 6, "remote_unclear": 4, "restricted_remote": -8, "onsite_explicit": -10}
REMOTE_ELIGIBILITY_ORDER = ("pakistan_explicit", "global_explicit", "regional_unconfirmed", "remote_unclear", "no_remote_evidence", "restricted_remote", "onsite_explicit")
ROLE_ORDER = ("exclude", "weak", "possible", "strong")
NO_MATCH_SCORE = -12


def place(value: Column, order: tuple[str, ...]) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), value), F.lit(0)), F.lit(len(order) + 1))


def recently_seen(as_of: Column, *stamps: Column) -> Column:
    """The latest of the stamps lies within the window, or a day ahead at most."""
    latest = F.greatest(*stamps) if len(stamps) > 1 else stamps[0]
    return F.coalesce((latest >= as_of - F.expr(f"INTERVAL {OBSERVATION_FRESHNESS_DAYS} DAYS")) & (latest <= as_of + F.expr("INTERVAL 1 DAY")), F.lit(False))


def opportunity_scores(jobs: DataFrame, as_of: str) -> DataFrame:
    """company_id, opportunity_score, best_remote_eligibility, role_match_status and the counts it rests on.

    jobs: company_id, cluster, managed, role_match_status, remote_eligibility, job_url, source_at, observed_at. Strong and possible roles match. A company with
    a matching managed posting is scored by those; else by its observed ones (the best cluster, plus two for each of up to three clusters, capped); else by what
    is left. All in two aggregations, both combined before their shuffle.
    """
    now = F.lit(as_of).cast("timestamp")
    matching = F.col("role_match_status").isin("strong", "possible")
    managed = F.coalesce("managed", F.lit(False))
    seen = F.when(F.col("source_at").isNotNull(), recently_seen(now, F.col("source_at"))).otherwise(recently_seen(now, F.col("observed_at")))
    link = F.coalesce(F.trim("job_url"), F.lit("")) != ""
    single = points(F.col("role_match_status"), OBSERVATION_ROLE_SCORES) + points(F.coalesce("remote_eligibility", F.lit("no_remote_evidence")), OBSERVATION_REMOTE_SCORE_ADJUSTMENTS)
    single = single + F.when(link, 6).otherwise(0) + F.when(seen, 4).otherwise(0)
    role, remote = F.when(matching | managed, F.col("role_match_status")), F.col("remote_eligibility")
    clusters = jobs.groupBy("company_id", "cluster").agg(
        F.max(F.when(matching & ~managed, single)).alias("observed"),
        F.max(matching & managed).alias("managed_match"),
        F.count_if(managed).alias("managed_rows"),
        F.max(F.when(managed, place(role, ROLE_ORDER))).alias("managed_role"),
        F.max(place(F.col("role_match_status"), ROLE_ORDER)).alias("role"),
        F.min(F.when(matching, place(remote, REMOTE_ELIGIBILITY_ORDER))).alias("remote"),
        F.min(F.when(matching & managed, place(remote, REMOTE_ELIGIBILITY_ORDER))).alias("managed_remote"),
        F.max(matching).alias("matches"),
    )
    company = clusters.groupBy("company_id").agg(
        F.count_if("managed_match").alias("managed_matching_count"),
        F.sum("managed_rows").alias("managed_active_count"),
        F.count("observed").alias("observed_clusters"),
        F.max("observed").alias("observed"),
        F.max("managed_role").alias("managed_role"),
        F.max("role").alias("role"),
        F.min(F.coalesce("managed_remote", F.lit(99))).alias("managed_remote"),
        F.min("remote").alias("remote"),
        F.max("matches").alias("matches"),
    )

    def named(position: Column, order: tuple[str, ...]) -> Column:
        return F.get(F.array(*map(F.lit, order)), position.cast("int") - 1)

    managed_role, role, best = named(F.col("managed_role"), ROLE_ORDER), named(F.col("role"), ROLE_ORDER), named(F.col("remote"), REMOTE_ELIGIBILITY_ORDER)
    managed_remote = F.coalesce(named(F.col("managed_remote"), REMOTE_ELIGIBILITY_ORDER), best, F.lit("no_remote_evidence"))
    by_managed = points(managed_role, MANAGED_ROLE_SCORES) + F.least("managed_matching_count", F.lit(10)) * 2 + F.when(F.col("managed_active_count") > 0, 8).otherwise(0) + points(managed_remote, MANAGED_REMOTE_SCORES)
    by_observed = F.least(F.col("observed") + F.least("observed_clusters", F.lit(3)) * 2, F.lit(OBSERVATION_OPPORTUNITY_SCORE_CAP))
    score = (
        F.when(F.col("managed_matching_count") > 0, by_managed)
        .when(F.col("observed_clusters") > 0, by_observed)
        .when(F.col("managed_active_count") > 0, NO_MATCH_SCORE)
        .when(F.col("matches"), points(role, ROLE_STATUS_SCORE_ADJUSTMENTS))
        .otherwise(0)
    )
    return company.select("company_id", score.cast("int").alias("opportunity_score"), best.alias("best_remote_eligibility"), role.alias("role_match_status"), "managed_matching_count", "managed_active_count", "observed_clusters")


def rank_companies(companies: DataFrame, scores: DataFrame) -> DataFrame:
    """companies (company_id, slug, company_fit_score) with fit_score = max(company_fit_score + opportunity_score, 0) and rank: best first, ties by slug. The rank is of a report: all companies in one order."""
    rows = companies.join(scores, "company_id", "left").withColumn("fit_score", F.greatest(F.col("company_fit_score") + F.coalesce("opportunity_score", F.lit(0)), F.lit(0)))
    return numbered(rows, [F.desc("fit_score"), F.col("slug")])




# Points for what a directory entry says.
PROTOTYPE_TERMS = {
    "open source": 6,
    "developer tools": 5,
    "infrastructure": 4,
    "artificial intelligence": 4,
    "ai": 3,
    "agent": 3,
    "security": 3,
    "analytics": 2,
    "productivity": 2,
    "b2b": 2,
}
REMOTE_REGIONS = ("Remote", "Fully Remote", "Partly Remote")
NEAR_REGIONS = ("Pakistan", "India", "South Asia", "Middle East and North Africa")


def prototype_score(blob: Column) -> Column:
    """Of a directory company (status, is_hiring, website, top_company, team_size, regions) and its lower-case text; an unknown team size counts as none, so as small."""
    size = F.coalesce("team_size", F.lit(0))
    score = (
        F.when(F.col("status") == "Active", 5).otherwise(0)
        + F.when(F.coalesce("is_hiring", F.lit(False)), 3).otherwise(0)
        + F.when(F.coalesce("website", F.lit("")) != "", 1).otherwise(0)
        + F.when(F.coalesce("top_company", F.lit(False)), 0).otherwise(1)
        + F.when(size <= 3, 6).when(size <= 5, 5).when(size <= 10, 4).when(size <= 25, 2).otherwise(0)
    )
    for term, value in PROTOTYPE_TERMS.items():
        score = score + F.when(F.contains(blob, F.lit(term)), value).otherwise(0)
    regions = F.coalesce("regions", F.array().cast("array<string>"))
    for names, value in ((REMOTE_REGIONS, 3), (NEAR_REGIONS, 2)):
        score = score + F.when(F.arrays_overlap(regions, F.array(*map(F.lit, names))), value).otherwise(0)
    return score
