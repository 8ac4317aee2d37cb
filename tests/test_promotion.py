"""Promotion: each outcome, the next tables, one version for all of them, and nothing where a table fails."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import companies as fits
from millrace.operators import directory, promotion, registry, staging
from millrace.sources.versions import Conflict, Versions, shared_folder

AT, NOW = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
JOBS = "source_id long, external_job_id string, status string, consecutive_misses int, content_hash string, first_seen_at timestamp, last_seen_at timestamp, last_changed_at timestamp, closed_at timestamp, title string, location string, posting_url string"


def jobs_of(spark, rows):
    at = F.lit(AT).cast("timestamp")
    table = spark.createDataFrame(rows, "source_id long, external_job_id string, status string, consecutive_misses int, content_hash string")
    names = [c.split()[0] for c in JOBS.split(", ")]
    more = {c: at for c in ("first_seen_at", "last_seen_at", "last_changed_at")} | {"closed_at": F.lit(None).cast("timestamp"), "title": F.lit("t"), "location": F.lit(None).cast("string"), "posting_url": F.lit(None).cast("string")}
    return table.withColumns(more).select(*names)


@pytest.fixture(scope="module")
def made(spark):
    urls = ["ok", "again", "amb", "nosnap", "closed", "bad", "later", "unknown", "noname", "named", "owned", "blank"]
    board = {"again": "b1", "ok": "b1", "closed": "b2", "blank": " "}
    leases = [(u, 1, f"t{u}", "p", board.get(u, f"n{u}"), "https://c", [1, 2] if u == "amb" else [77] if u == "unknown" else [1] if u == "owned" else [], None) for u in urls]
    snapshots = [(u, "p", board.get(u, f"n{u}"), u != "bad", 503 if u == "later" else 200, []) for u in urls if u != "nosnap"]
    postings = []
    for u in urls:
        for k in range(2):
            ext = "same" if u == "bad" else f"j{k}"
            postings.append((u, k, ext, f"T{k}", {"named": " Acme  Co", "noname": f"N{k}"}.get(u), f"h{k}", None, None))
    work = [(u, "promote", "leased", 0, 4 if u == "later" else 1, 4, AT, "w", f"t{u}", "2024-03-01 00:00:00", None) for u in urls]
    kinds = staging.WORK.replace("timestamp", "string")
    work = spark.createDataFrame(work, kinds).withColumns({c: F.col(c).cast("timestamp") for c in ("available_at", "lease_expires_at")})
    sources = [(1, 1, "p", "b1", "board", None, "complete_snapshot", "active", 1), (2, 2, "p", "b2", "board", None, "complete_snapshot", "disabled", 1)]
    stored = [(1, "One", "one", "one", None, None, "verified"), (2, "Two", "two", "nnamed", None, None, "verified")]
    tables = {
        "companies": spark.createDataFrame(stored, directory.COMPANIES),
        "sources": spark.createDataFrame(sources, registry.SOURCES),
        "candidates": spark.createDataFrame([(1, "p:nunknown:old", "unknown", None, "old", "t", "h", "normalized", [], None)], promotion.CANDIDATES),
        "jobs": jobs_of(spark, [(1, "j0", "active", 0, "h0"), (1, "gone", "active", 1, "x"), (2, "j0", "active", 1, "h0")]),
        "work": work,
    }
    return tables, spark.createDataFrame(leases, promotion.LEASES), spark.createDataFrame(snapshots, promotion.SNAPSHOTS), spark.createDataFrame(postings, promotion.POSTINGS)


def test_outcomes_and_next_tables(spark, made):
    tables, *given = made
    versions = Versions(spark, shared_folder(spark, "promotion"))
    versions.commit(tables)
    assert promotion.run(versions, *given, NOW) == 2
    now = versions.read()
    outcome = {r.normalized_url: r.outcome for r in now["decisions"].collect()}
    assert outcome == {
        "again": "promoted", "ok": "waits", "amb": "ambiguous_company_identity", "nosnap": "no_snapshot", "closed": "source_not_open", "bad": "incomplete_snapshot", "later": "incomplete_snapshot_for_now", "unknown": "unknown_company",
        "noname": "company_identity_required", "named": "promoted", "owned": "promoted", "blank": "incomplete_source_evidence",
    }
    state = {r.normalized_url: (r.stage, r.state) for r in now["work"].collect()}
    assert state["again"] == state["named"] == ("done", "done") and state["ok"] == ("promote", "leased") and state["nosnap"] == state["closed"] == ("promote", "retry")
    assert state["later"] == ("promote", "dead") and state["amb"] == state["bad"] == state["noname"] == ("promote", "quarantined")
    assert sorted((r.company_id, r.name, r.slug, r.identity_state) for r in now["companies"].collect()) == [(1, "One", "one", "verified"), (2, "Two", "nnamed", "verified"), (3, "Acme  Co", "nnamed-board-nnamed", "provisional")]
    sources = {r.external_id: (r.source_id, r.company_id) for r in now["sources"].collect()}
    assert sources == {"b1": (1, 1), "b2": (2, 2), "nnamed": (3, 3), "nowned": (4, 1)}
    jobs = {(r.source_id, r.external_job_id): (r.status, r.consecutive_misses) for r in now["jobs"].collect()}
    assert jobs == {(1, "j0"): ("active", 0), (1, "j1"): ("active", 0), (1, "gone"): ("closed", 2), (2, "j0"): ("active", 1), **{(s, j): ("active", 0) for s in (3, 4) for j in ("j0", "j1")}}
    candidates = {r.candidate_key: (r.status, r.source_id, list(r.flags)) for r in now["candidates"].collect()}
    assert candidates["p:b1:j0"] == ("promoted", 1, []) and candidates["p:nnamed:j1"] == ("promoted", 3, []) and candidates["p:nnoname:j0"] == ("quarantined", None, [])
    assert candidates["p:nbad:same:duplicate-1"] == ("quarantined", None, ["invalid_snapshot"]) and candidates["p:nlater:j0"] == ("normalized", None, ["invalid_snapshot"])
    assert candidates["p:nunknown:old"][0] == "quarantined" and not any(k.startswith("p:namb") for k in candidates)
    # Again on the new version: what is promoted stays, and the one that waited has its turn.
    more = [g.where("normalized_url = 'ok'") for g in given]
    assert promotion.run(versions, *more, NOW) == 3
    again = versions.read()
    assert {r.external_id for r in again["sources"].collect()} == set(sources) and again["jobs"].count() == len(jobs)
    assert {r.normalized_url: r.state for r in again["work"].collect()}["ok"] == "done"


def test_nothing_is_published_where_a_table_fails_or_a_writer_was_faster(spark, made):
    tables, *given = made
    versions = Versions(spark, shared_folder(spark, "promotion"))
    versions.commit(tables)
    broken = given[2].withColumn("content_hash", F.when(F.col("normalized_url") == "again", F.raise_error(F.lit("lost"))).otherwise(F.col("content_hash")))
    with pytest.raises(Exception, match="lost"):
        promotion.run(versions, given[0], given[1], broken, NOW)
    assert versions.latest() == 1 and versions.read()["jobs"].count() == 3
    found = promotion.promote(versions.read(1), *given, NOW)
    versions.commit({"jobs": tables["jobs"]})
    with pytest.raises(Conflict):
        versions.commit(found, expected=1)
    assert versions.latest() == 2 and versions.read()["companies"].count() == 2


def test_company_fit(spark):
    base = dict(name="Acme", one_liner=None, industry=None, subindustry=None, industries=["Cloud"], tags=["ai"], regions=["Remote"], all_locations=None, prototype_angle=None, prototype_score=70, directory_url="u", status="Active", website="w", is_hiring=True, team_size=5, batch="W2025")
    other = {**base, "name": "Pair", "industries": [], "tags": ["maid"], "regions": [], "prototype_score": None, "status": None, "is_hiring": None, "team_size": 80, "batch": None, "directory_url": None}
    names = ["slug", *base]
    kinds = "slug string, name string, one_liner string, industry string, subindustry string, industries array<string>, tags array<string>, regions array<string>, all_locations string, prototype_angle string, prototype_score int, directory_url string, status string, website string, is_hiring boolean, team_size int, batch string"
    rows = [("a", *base.values()), ("b", *other.values()), ("c", *{**base, "website": ""}.values()), ("d", *{**other, "team_size": None}.values())]
    table = spark.createDataFrame(rows, kinds)
    assert table.columns == names
    got = {r.slug: (r.fit_score, r.candidate_strength_matches, r["rank"]) for r in fits.ranked(table, "Cloud and AI engineer", max_team_size=None).collect()}
    assert got == {"a": (50 + 8 + 4 + 8 + 14 + 4 + 5 + 16 + 7, ["Backend systems", "AI/LLM"], 1), "b": (0, [], 3), "d": (4, [], 2)}
    assert [r.fit_reasons for r in fits.fit(table, "x").where("slug = 'd'").collect()] == [[fits.REASONS["website"], fits.REASONS["general"]]]
    targets = spark.createDataFrame([("a", 10, 1, "not_hiring", None), ("b", 5, 2, "hiring", "possible"), ("c", 5, 3, "hiring", "possible"), ("d", None, 4, None, "strong")], "slug string, fit_score int, rank long, verified_hiring_status string, role_fit string")
    assert sorted((r["rank"], r.slug, r.fit_score) for r in fits.reranked(targets).collect()) == [(1, "b", 30), (2, "c", 30), (3, "d", 12), (4, "a", 0)]
