"""Sources of companies under compare and set: each request names the owner that it expects, and is refused where that is no longer so.

Requests are applied in their order. Only requests for one source depend on each other, so each source's requests are folded as a stream, one row at a time, and sources side by side.
A provider's identity belongs to one company: registering it again for its owner brings it up to date, for another company it is refused; only ``reassign`` moves it, and
only from the expected owner. Postings and runs stay with the source.

Every request gets a row: what was done with it, the owner, status and version of its source before and after. ``version`` counts the changes to a source; a request may expect one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranks import numbered
from millrace.sources.versions import cut

SOURCES = "source_id long, company_id long, provider string, external_id string, source_kind string, source_url string, sync_mode string, status string, version long"
#: action: register (company_id is the owner), reassign (company_id is the new owner) or disable. expected_company_id is needed by the last two; expected_version may be null.
REQUESTS = "request_no long, action string, provider string, external_id string, company_id long, expected_company_id long, expected_version long, source_kind string, source_url string, sync_mode string, reason string"
SYNC_MODES = ("none", "complete_snapshot", "observation")
_OUTCOME = (
    "provider string, external_id string, request_no long, action string, outcome string, company_before long, company_after long, status_before string, status_after string, version_after long, "
    "source_id long, source_kind string, source_url string, sync_mode string"
)
_NAMES = [c.split()[0] for c in _OUTCOME.split(", ")]
_STATE = ("source_id", "company_id", "source_kind", "source_url", "sync_mode", "status", "version")


def _judge(now: dict | None, r: dict) -> str:
    """What becomes of a request, by the first rule that holds."""
    if r["problem"]:
        return r["problem"]
    if r["action"] == "register":
        if now is None:
            return "created"
        return "updated" if now["company_id"] == r["company_id"] else "owner_differs"
    if now is None:
        return "unknown_source"
    if now["company_id"] != r["expected_company_id"]:
        return "owner_differs"
    if r["expected_version"] is not None and now["version"] != r["expected_version"]:
        return "version_differs"
    if r["running"]:
        return "runs_in_progress"
    if not r["expected_known"]:
        return "unknown_company"
    if r["action"] == "disable":
        return "already_disabled" if now["status"] == "disabled" else "disabled"
    if not r["company_known"]:
        return "unknown_target"
    return "same_owner" if r["company_id"] == now["company_id"] else "reassigned"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by source: the stored one (request_no null) first, then its requests in order."""
    key, now = None, None
    for batch in batches:
        found = []
        for r in batch.to_pylist():
            if (r["provider"], r["external_id"]) != key:
                key, now = (r["provider"], r["external_id"]), None
            if r["request_no"] is None:
                now = {c: r[c] for c in _STATE}
                continue
            outcome, before = _judge(now, r), now or dict.fromkeys(_STATE)
            if outcome == "created":
                now = {**{c: r[c] for c in _STATE}, "source_id": None, "status": "active", "version": 1}
            elif outcome == "updated":
                now = {**now, **{c: r[c] for c in ("source_kind", "source_url", "sync_mode")}, "version": now["version"] + 1}
            elif outcome == "disabled":
                now = {**now, "status": "disabled", "version": now["version"] + 1}
            elif outcome == "reassigned":
                now = {**now, "company_id": r["company_id"], "version": now["version"] + 1}
            after = now or dict.fromkeys(_STATE)
            states = {"company_before": before["company_id"], "company_after": after["company_id"], "status_before": before["status"], "status_after": after["status"], "version_after": after["version"]}
            found.append({**r, **{c: after[c] for c in ("source_id", "source_kind", "source_url", "sync_mode")}, **states, "outcome": outcome})
        if found:
            kinds = [pa.int64() if c.endswith("long") else pa.string() for c in _OUTCOME.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], k) for n, k in zip(_NAMES, kinds)], _NAMES)


def apply_requests(sources: DataFrame, requests: DataFrame, companies: DataFrame, running: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The next sources, and what became of each request (``_OUTCOME``; outcomes other than created, updated, reassigned and disabled are refusals).

    companies: company_id. running: source_id of the runs in progress. New sources get ids after the greatest one, in the order of the requests that made them.
    """
    provider, external = F.lower(F.trim("provider")), F.trim("external_id")
    asked = requests.withColumns({"provider": F.coalesce(provider, F.lit("")), "external_id": F.coalesce(external, F.lit(""))})
    repair = F.col("action").isin("reassign", "disable")
    known = companies.select("company_id").distinct()
    asked = asked.join(known.withColumn("company_known", F.lit(True)), "company_id", "left")
    asked = asked.join(known.select(F.col("company_id").alias("expected_company_id"), F.lit(True).alias("expected_known")), "expected_company_id", "left")
    asked = asked.fillna(False, ["company_known", "expected_known"])
    problem = (
        F.when(~F.col("action").isin("register", "reassign", "disable") | F.col("action").isNull(), "unknown_action")
        .when((F.col("provider") == "") | (F.col("external_id") == ""), "blank_identity")
        .when(repair & (F.trim(F.coalesce("reason", F.lit(""))) == ""), "no_reason")
        .when(repair & ~F.coalesce(F.col("expected_company_id") > 0, F.lit(False)), "no_expected_owner")
        .when((F.col("action") == "reassign") & F.col("company_id").isNull(), "no_target")
        .when((F.col("action") == "register") & ~F.coalesce(F.col("sync_mode").isin(*SYNC_MODES), F.lit(False)), "unsupported_sync_mode")
        .when((F.col("action") == "register") & ~F.col("company_known"), "unknown_company")
    )
    asked = asked.withColumn("problem", problem)
    busy = running.select("source_id").distinct().withColumn("running", F.lit(True))
    of = sources.join(busy, "source_id", "left").select("provider", "external_id", "running")
    asked = asked.join(of, ["provider", "external_id"], "left").fillna(False, ["running"])
    stored = sources.join(asked.select("provider", "external_id").distinct(), ["provider", "external_id"], "left_semi")
    rows = stored.unionByName(asked, allowMissingColumns=True).repartition("provider", "external_id").sortWithinPartitions("provider", "external_id", F.col("request_no").asc_nulls_first())
    outcomes = cut(rows.mapInArrow(_fold, _OUTCOME), "outcomes")

    last = outcomes.where("version_after IS NOT NULL").groupBy("provider", "external_id").agg(F.max_by(F.struct(*_NAMES[6:]), "request_no").alias("r"))
    made = outcomes.where("outcome = 'created'").select("provider", "external_id", "request_no")
    most = sources.agg(F.max("source_id")).first()[0] or 0
    ids = numbered(made, [F.col("request_no")], "number").select("provider", "external_id", (F.col("number") + most).alias("new_id"))
    changed = last.join(ids, ["provider", "external_id"], "left").select(
        F.coalesce("r.source_id", "new_id").alias("source_id"),
        F.col("r.company_after").alias("company_id"),
        "provider",
        "external_id",
        *[F.col(f"r.{c}") for c in ("source_kind", "source_url", "sync_mode")],
        F.col("r.status_after").alias("status"),
        F.col("r.version_after").alias("version"),
    )
    kept = sources.join(changed.select("provider", "external_id"), ["provider", "external_id"], "left_anti")
    return kept.select(*changed.columns).unionByName(changed), outcomes
