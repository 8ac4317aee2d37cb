"""Promotion: parsed boards whose snapshots hold become sources, companies and postings, in one version of all tables.

``promote`` is a function from the tables of a version to those of the next; ``run`` commits them together, so that readers see all of them or none, and a writer that was overtaken
fails. Each leased work item brings the board that its page was parsed to and that board's snapshot. What becomes of it is the first of DECISIONS that holds.

A new board belongs to the company that its observations assert, if they assert one; else to a provisional company of the name that all its postings agree on; else to none, and it
is quarantined. Of several items for one new board the first that passes decides the owner, and of several items for one board only the first (by URL) applies its snapshot; the others
wait. Snapshots of other boards than the promoted ones change no posting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import lifecycle, registry, staging
from millrace.operators.directory import free_slugs
from millrace.operators.ranks import numbered
from millrace.operators.records import confirmed_names
from millrace.sources.sinks import upsert
from millrace.sources.versions import Versions, cut

#: Leased items with what parsing and observations say of them; proposed_company_id may be null.
LEASES = "normalized_url string, run_id long, lease_token string, provider string, external_source_id string, canonical_url string, asserted_ids array<long>, proposed_company_id long"
SNAPSHOTS = "normalized_url string, provider string, external_source_id string, is_complete boolean, http_status int, error_kinds array<string>"
POSTINGS = "normalized_url string, position int, external_job_id string, title string, company_name string, content_hash string, location string, posting_url string"
CANDIDATES = "run_id long, candidate_key string, normalized_url string, source_id long, external_job_id string, title string, content_hash string, status string, flags array<string>, error string"
# Answers and faults after which a later attempt may succeed.
RETRY_STATUS = (408, 425, 429)
RETRY_KINDS = ("connecterror", "connecttimeout", "networkerror", "ratelimit", "readerror", "readtimeout", "remoteprotocolerror")
#: Outcomes in the order of their tests, and what the work item's result is.
DECISIONS = {
    "incomplete_source_evidence": "quarantined",
    "ambiguous_company_identity": "quarantined",
    "no_snapshot": "failed",
    "source_not_open": "failed",
    "incomplete_snapshot": "quarantined",
    "incomplete_snapshot_for_now": "failed",
    "unknown_company": "quarantined",
    "company_identity_required": "quarantined",
    "waits": None,
    "promoted": "ok",
}
PUBLIC = ("title", "location", "posting_url")


def decide(leases: DataFrame, snapshots: DataFrame, postings: DataFrame, sources: DataFrame, companies: DataFrame) -> DataFrame:
    """The leases with ``outcome``, source_id and company_id (of boards that are known), owner_id (asserted) and confirmed_name (of boards that are not). A written table."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    ids = postings.groupBy("normalized_url", F.trim(F.coalesce("external_job_id", F.lit(""))).alias("id")).agg(F.count(F.lit(1)).alias("n"), F.max(blank("title")).alias("untitled"))
    faulty = ids.groupBy("normalized_url").agg(F.max((F.col("n") > 1) | (F.col("id") == "") | F.col("untitled")).alias("faulty"))
    names = confirmed_names(postings, ["normalized_url"], "company_name", "position")
    head = snapshots.select("normalized_url", F.col("provider").alias("_provider"), F.col("external_source_id").alias("_external"), "is_complete", "http_status", "error_kinds", F.lit(True).alias("_there"))
    known = sources.select("provider", F.col("external_id").alias("external_source_id"), "source_id", "company_id", F.col("status").alias("_status"), "sync_mode")
    rows = leases.join(head, "normalized_url", "left").join(faulty, "normalized_url", "left").join(names, "normalized_url", "left").join(known, ["provider", "external_source_id"], "left")
    owner = F.coalesce(F.when(F.size("asserted_ids") == 1, F.col("asserted_ids")[0]), F.col("proposed_company_id"))
    rows = rows.withColumn("owner_id", F.when(F.col("source_id").isNull(), owner))
    rows = rows.join(companies.select(F.col("company_id").alias("owner_id"), F.lit(True).alias("_owner")), "owner_id", "left")
    bad = (
        ~F.col("_provider").eqNullSafe(F.col("provider"))
        | ~F.col("_external").eqNullSafe(F.col("external_source_id"))
        | ~F.coalesce("is_complete", F.lit(False))
        | (F.coalesce(F.size("error_kinds"), F.lit(0)) > 0)
        | (F.coalesce("http_status", F.lit(200)) != 200)
        | F.coalesce("faulty", F.lit(False))
    )
    later = F.col("http_status").isNull() | (F.col("http_status") >= 500) | F.col("http_status").isin(*RETRY_STATUS)
    later = later | F.exists(F.coalesce("error_kinds", F.array()), lambda k: F.lower(k).isin(*RETRY_KINDS))
    new = F.col("source_id").isNull()
    outcome = (
        F.when(blank("provider") | blank("external_source_id") | blank("canonical_url"), "incomplete_source_evidence")
        .when(F.coalesce(F.size("asserted_ids"), F.lit(0)) > 1, "ambiguous_company_identity")
        .when(F.col("_there").isNull(), "no_snapshot")
        .when(~new & ((F.col("_status") != "active") | (F.col("sync_mode") != "complete_snapshot")), "source_not_open")
        .when(bad, F.when(later, "incomplete_snapshot_for_now").otherwise("incomplete_snapshot"))
        .when(new & F.col("owner_id").isNotNull() & F.col("_owner").isNull(), "unknown_company")
        .when(new & F.col("owner_id").isNull() & F.col("confirmed_name").isNull(), "company_identity_required")
        .otherwise("promoted")
    )
    rows = cut(rows.select(*leases.columns, "source_id", "company_id", "owner_id", "confirmed_name", outcome.alias("outcome")), "decided")
    first = rows.where("outcome = 'promoted'").groupBy("provider", "external_source_id").agg(F.min("normalized_url").alias("_first"))
    waits = (F.col("outcome") == "promoted") & (F.col("normalized_url") != F.col("_first"))
    return cut(rows.join(first, ["provider", "external_source_id"], "left").withColumn("outcome", F.when(waits, "waits").otherwise(F.col("outcome"))).drop("_first"), "outcomes")


def candidate_rows(leases: DataFrame, postings: DataFrame) -> DataFrame:
    """CANDIDATES of the leases' postings: ids that one board brings more than once, or not at all, get keys of their own."""
    own = postings.join(leases.select("normalized_url", "run_id", "provider", "external_source_id", "source_id", "outcome"), "normalized_url")
    id = F.nullif(F.trim("external_job_id"), F.lit(""))
    own = own.withColumn("_id", id)
    repeated = own.where("_id IS NOT NULL").groupBy("normalized_url", "_id").agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    own = own.join(repeated, ["normalized_url", "_id"], "left")
    place = F.col("position").cast("string")
    mark = F.when(F.col("_id").isNull(), F.concat(F.lit("missing-id-"), place)).when(F.col("_repeated"), F.concat(F.col("_id"), F.lit(":duplicate-"), place)).otherwise(F.col("_id"))
    faulty = F.col("outcome").startswith("incomplete_snapshot")
    status = F.when(faulty, "normalized").when(F.col("outcome") == "promoted", "promoted").otherwise("quarantined")
    return own.select(
        "run_id",
        F.concat_ws(":", "provider", "external_source_id", mark).alias("candidate_key"),
        "normalized_url",
        "source_id",
        F.col("_id").alias("external_job_id"),
        "title",
        "content_hash",
        status.alias("status"),
        F.when(faulty, F.array(F.lit("invalid_snapshot"))).otherwise(F.array().cast("array<string>")).alias("flags"),
        F.lit(None).cast("string").alias("error"),
    )


def promote(tables: dict[str, DataFrame], leases: DataFrame, snapshots: DataFrame, postings: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The next ``companies``, ``sources``, ``candidates``, ``jobs`` and ``work`` of the given ones, and ``decisions`` (what became of each lease). jobs: the columns of ``lifecycle`` with PUBLIC."""
    decided = decide(leases, snapshots, postings, tables["sources"], tables["companies"])
    fresh = cut(decided.where("outcome = 'promoted' AND source_id IS NULL"), "fresh")
    named = fresh.where("owner_id IS NULL").select("normalized_url", "provider", "external_source_id", F.col("confirmed_name").alias("name"))
    most = tables["companies"].agg(F.max("company_id")).first()[0] or 0
    founded = numbered(named, [F.col("normalized_url")], "_n").withColumn("company_id", F.col("_n") + most)
    founded = cut(founded.withColumn("position", F.col("_n")).withColumn("slug", F.col("external_source_id")).withColumn("external_id", F.col("external_source_id")), "founded")
    slugs = free_slugs(founded.select("position", "external_id", "slug"), tables["companies"], "board")
    made = founded.drop("slug").join(slugs, "position").select(
        "company_id", "name", text.normalize_company_name(F.col("name")).alias("normalized_name"), "slug", F.lit(None).cast("string").alias("website"), F.lit(None).cast("string").alias("primary_domain"), F.lit("provisional").alias("identity_state")
    )
    companies = cut(tables["companies"].unionByName(made), "companies")

    owners = fresh.join(founded.select("normalized_url", F.col("company_id").alias("_new")), "normalized_url", "left")
    requests = numbered(owners.select("provider", "external_source_id", "canonical_url", "normalized_url", F.coalesce("owner_id", "_new").alias("company_id")), [F.col("normalized_url")], "request_no").select(
        "request_no", F.lit("register").alias("action"), "provider", F.col("external_source_id").alias("external_id"), "company_id", F.lit(None).cast("long").alias("expected_company_id"), F.lit(None).cast("long").alias("expected_version"),
        F.lit("board").alias("source_kind"), F.col("canonical_url").alias("source_url"), F.lit("complete_snapshot").alias("sync_mode"), F.lit(None).cast("string").alias("reason")
    )
    none = tables["sources"].select("source_id").limit(0)
    sources, _ = registry.apply_requests(tables["sources"], requests, companies.select("company_id"), none)
    sources = cut(sources, "sources")

    of = sources.select("provider", F.col("external_id").alias("external_source_id"), F.col("source_id").alias("_source"), F.col("company_id").alias("_company"))
    done = decided.join(of, ["provider", "external_source_id"], "left").withColumns({"source_id": F.coalesce("source_id", "_source"), "company_id": F.coalesce("company_id", "_company")}).drop("_source", "_company")
    done = cut(done, "done")
    promoted = done.where("outcome = 'promoted'").select("normalized_url", "source_id")
    seen = postings.join(promoted, "normalized_url").select("source_id", F.trim("external_job_id").alias("external_job_id"), "content_hash", *PUBLIC)
    touched = tables["jobs"].join(promoted.select("source_id"), "source_id", "left_semi")
    jobs, _ = lifecycle.apply_snapshot(touched, seen, as_of, public=PUBLIC)
    jobs = tables["jobs"].join(promoted.select("source_id"), "source_id", "left_anti").unionByName(jobs)

    rows = candidate_rows(done.where(F.col("outcome").isin("promoted", "company_identity_required") | F.col("outcome").startswith("incomplete_snapshot")), postings)
    candidates = upsert(tables["candidates"], rows.dropDuplicates(["run_id", "candidate_key"]), ["run_id", "candidate_key"])
    failed = [name for name, value in DECISIONS.items() if value == "quarantined"]
    stopped = done.where(F.col("outcome").isin(failed)).select("run_id", "normalized_url", F.col("outcome").alias("_why"))
    candidates = candidates.join(stopped, ["run_id", "normalized_url"], "left").withColumn("_on", F.col("_why").isNotNull() & (F.col("status") != "promoted"))
    candidates = candidates.withColumns({"status": F.when(F.col("_on"), "quarantined").otherwise(F.col("status")), "error": F.when(F.col("_on"), F.col("_why")).otherwise(F.col("error"))})
    candidates = candidates.select(*tables["candidates"].columns)

    result = F.lit(None).cast("string")
    for name, value in DECISIONS.items():
        if value:
            result = F.when(F.col("outcome") == name, value).otherwise(result)
    settled = done.withColumn("_result", result).where("_result IS NOT NULL")
    settled = settled.select("normalized_url", "lease_token", F.col("_result").alias("outcome"), F.when(F.col("_result") != "ok", F.col("outcome")).alias("error"), F.lit(None).cast("double").alias("retry_after"))
    work = staging.settle(tables["work"], settled, as_of)
    return {"companies": companies, "sources": sources, "candidates": candidates, "jobs": jobs, "work": work, "decisions": done}


def run(versions: Versions, leases: DataFrame, snapshots: DataFrame, postings: DataFrame, as_of: str) -> int:
    """Promote on the latest version and commit the next one; a newer version in between is a ``Conflict``, and nothing is published."""
    start = versions.latest()
    found = promote(versions.read(start), leases, snapshots, postings, as_of)
    return versions.commit(found, expected=start)

