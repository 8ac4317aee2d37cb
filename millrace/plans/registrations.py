"""Operators whose rows depend on the rows before them: the lifecycle as a stream, a directory's companies, requests for sources. Events stand for runs, customers for a directory's companies, suppliers for stored ones, orders for requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text, websites
from millrace.operators import directory, promotion, registry, staging
from millrace.sources.tables import load
from millrace.sources.versions import Versions, cut, shared_folder
from millrace.streaming import lifecycle

from .registry import query

#: The event table's days go through the stream in so many runs of one checkpoint, each of which may take several micro-batches.
RESTARTS = 3
#: Postings of all runs and sources for each bucket of a source, so that a group of the stream does not grow with the table.
POSTINGS_A_BUCKET = 250_000
#: The same for each partition of its state, whose fixed costs in each micro-batch should stay far below what its rows cost.
POSTINGS_A_PARTITION = 500_000


@query("""
WITH days AS (
    SELECT event_type AS source_id, user_id, date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) + 1 AS run_no, props,
           row_number() OVER (PARTITION BY event_type, user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS k FROM events
), runs AS (
    SELECT source_id, run_no, row_number() OVER (PARTITION BY source_id ORDER BY run_no) AS c
    FROM (SELECT DISTINCT source_id FROM days), (SELECT unnest(range(1, (SELECT max(run_no) FROM days) + 1)) AS run_no) WHERE run_no % 10 <> 7
), seen AS (
    SELECT source_id, user_id, c, sha256(props) AS h, lag(c) OVER w AS before, lag(sha256(props)) OVER w AS old, lead(c) OVER w AS following
    FROM days JOIN runs USING (source_id, run_no) WHERE k = 1 WINDOW w AS (PARTITION BY source_id, user_id ORDER BY c)
), counted AS (
    SELECT r.source_id, r.run_no, r.c,
           count(*) FILTER (s.c = r.c AND before IS NULL) AS jobs_added, count(*) FILTER (s.c = r.c AND old <> h) AS jobs_updated, count(*) FILTER (s.c = r.c AND old = h) AS jobs_unchanged,
           count(*) FILTER (s.c < r.c AND coalesce(following, 1000) > r.c) AS jobs_missed, count(*) FILTER (s.c = r.c - 2 AND coalesce(following, 1000) > r.c) AS jobs_closed,
           count(*) FILTER (s.c = r.c AND s.c - before > 2) AS jobs_reactivated
    FROM runs r LEFT JOIN seen s ON s.source_id = r.source_id AND s.c <= r.c GROUP BY ALL
)
SELECT source_id, run_no, jobs_added, jobs_updated, jobs_unchanged, jobs_missed, jobs_closed, jobs_reactivated FROM counted
UNION ALL
SELECT DISTINCT source_id, n, 0, 0, 0, 0, 0, 0 FROM days, (SELECT unnest(range(1, (SELECT max(run_no) FROM days) + 1)) AS n) WHERE n % 10 = 7
""")
def lifecycle_stream(spark, sf):
    events, folder = load(spark, sf, "events"), shared_folder(spark, "lifecycle")
    day = F.datediff(F.to_date("ts"), F.lit(events.agg(F.min(F.to_date("ts"))).first()[0])) + 1
    own = events.select(F.col("event_type").alias("source_id"), day.cast("long").alias("run_no"), F.col("user_id").cast("string").alias("external_job_id"), "ts", "event_id", "props")
    own = own.groupBy("source_id", "run_no", "external_job_id").agg(F.sha2(F.max_by("props", F.struct("ts", "event_id")), 256).alias("content_hash")).withColumn("is_complete", F.lit(None).cast("boolean"))
    own = cut(own, "seen")
    last, postings = own.agg(F.coalesce(F.max("run_no"), F.lit(0)), F.count(F.lit(1))).first()
    runs = own.select("source_id").distinct().withColumn("run_no", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(last).cast("long"))))
    runs = runs.select("source_id", "run_no", F.lit(None).cast("string").alias("external_job_id"), F.lit(None).cast("string").alias("content_hash"), (F.col("run_no") % 10 != 7).alias("is_complete"))
    rows, buckets, partitions = own.unionByName(runs), max(4, postings // POSTINGS_A_BUCKET), max(8, postings // POSTINGS_A_PARTITION)
    for k in range(RESTARTS):
        lifecycle.append(rows.where(F.floor((F.col("run_no") - 1) * RESTARTS / last) == k), f"{folder}/rows", files=2)
        lifecycle.run_once(spark, f"{folder}/rows", f"{folder}/changes", f"{folder}/checkpoint", buckets=buckets, files_a_batch=1, partitions=partitions)
    return lifecycle.run_counters(spark.read.schema(lifecycle.OUTPUT).parquet(f"{folder}/changes"))


_DIRECTORY = """
WITH RECURSIVE companies AS (
    SELECT s_suppkey AS id, lower(s_name) AS n, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'd' || ((s_suppkey + 1) * 7 % 1999) || '.example' END AS d, s_suppkey % 3 <> 0 AND s_suppkey % 6 <> 1 AS k FROM supplier
), batch AS (
    SELECT c_custkey AS p, CAST(c_custkey AS VARCHAR) AS ext,
           CASE WHEN c_custkey % 50 = 7 THEN 'Acme ' || (c_custkey // 50) || ' Inc' WHEN c_custkey % 6 = 1 AND s_name IS NOT NULL THEN upper(s_name) ELSE c_name END AS name,
           CASE WHEN c_custkey % 50 IN (7, 8, 9) THEN 'acme' || (c_custkey // 50) || '.example'
                WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN NULL ELSE 'd' || (c_custkey * 7 % 1999) || '.example' END AS d
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey - 1
), claimed AS (
    SELECT *, lower(name) AS n, d AS asked, count(*) OVER (PARTITION BY d) AS claims,
           count(*) FILTER (name LIKE 'Acme%' AND d LIKE 'acme%') OVER (PARTITION BY d) AS fitting FROM batch
), rows AS (
    SELECT row_number() OVER (ORDER BY p) AS i, p, ext, claimed.n, asked, CASE WHEN claims = 1 OR (fitting = 1 AND name LIKE 'Acme%' AND asked LIKE 'acme%') THEN asked END AS d,
           CASE WHEN companies.k THEN companies.id END AS x FROM claimed LEFT JOIN companies ON CAST(companies.id AS VARCHAR) = ext
), f AS (
    SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS p, '' AS ext, '' AS h, '' AS action, '' AS now_d, false AS refused,
           (SELECT map(list('c' || id), list({'d': d, 'n': n, 'k': k})) FROM companies) AS st
    UNION ALL
    SELECT i, p, ext, h, action, now_d, refused, CASE WHEN action = 'created' THEN st ELSE map_concat(st, map([h], [{'d': now_d, 'n': n, 'k': true}])) END FROM (
        SELECT i, p, ext, n, st, coalesce(h0, 'n' || p) AS h, CASE WHEN h0 IS NULL THEN 'created' WHEN x IS NULL THEN 'matched' ELSE 'updated' END AS action,
               taken OR (d IS NULL AND asked IS NOT NULL) AS refused, CASE WHEN d IS NOT NULL AND NOT taken THEN d WHEN h0 IS NOT NULL THEN st[h0].d END AS now_d
        FROM (
            SELECT *, d IS NOT NULL AND len(list_filter(map_entries(st), lambda e: e.value.d = d AND e.key <> coalesce(h0, ''))) > 0 AS taken FROM (
                SELECT *, CASE WHEN x IS NOT NULL THEN 'c' || x WHEN len(c) = 1 AND NOT c[1].value.k THEN c[1].key END AS h0 FROM (
                    SELECT rows.*, f.st, list_filter(map_entries(f.st), lambda e: e.value.d = rows.d AND e.value.n = rows.n) AS c FROM f JOIN rows ON rows.i = f.i + 1
                )
            )
        )
    )
)
"""


@query(
    _DIRECTORY
    + """
, made AS (
    SELECT p, ext, (SELECT max(id) FROM companies) + row_number() OVER (ORDER BY p) AS id, 'c' || (p % 700) AS base, row_number() OVER (PARTITION BY p % 700 ORDER BY p) AS k FROM f WHERE action = 'created'
), slugs AS (
    SELECT p, id, CASE WHEN k = 1 AND base NOT IN (SELECT 'c' || s_suppkey FROM supplier) THEN base ELSE base || '-dir-' || ext END AS slug FROM made
)
SELECT f.p AS position, f.ext AS external_id, action, coalesce(id, CAST(substr(h, 2) AS BIGINT)) AS company_id, coalesce(slug, 'c' || substr(h, 2)) AS slug, now_d AS primary_domain, refused
FROM f LEFT JOIN slugs ON slugs.p = f.p WHERE f.i > 0
"""
)
def directory_upsert(spark, sf):
    suppliers, key = load(spark, sf, "supplier"), F.col("s_suppkey")
    site = F.when(key % 5 != 0, F.concat(F.lit("https://www.d"), (key + 1) * 7 % 1999, F.lit(".example/about")))
    companies = suppliers.select(
        key.alias("company_id"), F.col("s_name").alias("name"), text.normalize_company_name(F.col("s_name")).alias("normalized_name"), F.concat(F.lit("c"), key).alias("slug"), site.alias("website"),
        websites.website_domain(site).alias("primary_domain"), F.lit("provisional").alias("identity_state")
    )
    known = suppliers.where((key % 3 != 0) & (key % 6 != 1)).select(
        key.alias("company_id"), F.lit("dir").alias("provider"), key.cast("string").alias("external_id"), F.lit("").alias("source_url"), F.lit("active").alias("status"), F.lit(None).cast("string").alias("conflict")
    )
    c = F.col("c_custkey")
    names = suppliers.select((key + 1).alias("c_custkey"), F.upper("s_name").alias("above"))
    claim = (
        F.when((c % 50).isin(7, 8, 9), F.concat(F.lit("acme"), F.floor(c / 50), F.lit(".example")))
        .when(c % 11 == 0, F.concat(F.lit("https://www.linkedin.com/company/"), c))
        .when(c % 13 == 0, F.lit("see http://a.example and http://b.example"))
        .otherwise(F.concat(F.lit(" https://d"), c * 7 % 1999, F.lit(".example ")))
    )
    batch = load(spark, sf, "customer").join(names, "c_custkey", "left").select(
        c.alias("position"),
        c.cast("string").alias("external_id"),
        F.when(c % 50 == 7, F.concat(F.lit("Acme "), F.floor(c / 50), F.lit(" Inc"))).when((c % 6 == 1) & F.col("above").isNotNull(), F.col("above")).otherwise(F.col("c_name")).alias("name"),
        claim.alias("website"),
        F.concat(F.lit("c"), c % 700).alias("slug"),
    )
    found = directory.upsert(batch, companies, known, "dir", "https://directory.example/companies/")
    rows = found["decisions"].join(found["companies"].select("company_id", "slug"), "company_id")
    return rows.select("position", "external_id", "action", "company_id", "slug", F.col("domain").alias("primary_domain"), F.col("claimed_domain").isNotNull().alias("refused"))


@query("""
WITH RECURSIVE stored AS (
    SELECT 'b' || s_suppkey AS ext, s_suppkey % 50 + 1 AS owner, CASE WHEN s_suppkey % 9 = 0 THEN 'disabled' ELSE 'active' END AS status, 1 AS v, s_suppkey % 17 = 0 AS busy FROM supplier
), req AS (
    SELECT o_orderkey AS no, 'b' || (o_custkey % 130) AS ext, CASE o_orderkey % 4 WHEN 0 THEN 'register' WHEN 1 THEN 'disable' ELSE 'reassign' END AS action,
           CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 130 % 50 + 1 WHEN o_orderkey % 23 = 2 THEN 9999 ELSE o_orderkey % 50 + 1 END AS company,
           CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 130 % 50 + 1 ELSE (o_orderkey + 43) % 50 + 1 END AS expected,
           CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 4 + 1 END AS expected_v, o_orderkey % 29 <> 0 AS reasoned FROM orders
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY ext ORDER BY no) AS k FROM req
), f AS (
    SELECT DISTINCT r.ext, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS no, '' AS outcome, CAST(owner AS BIGINT) AS owner, status, CAST(v AS BIGINT) AS v, coalesce(busy, false) AS busy
    FROM req r LEFT JOIN stored s ON s.ext = r.ext
    UNION ALL
    SELECT ext, k, no, outcome, CASE WHEN outcome IN ('created', 'reassigned') THEN company ELSE owner END,
           CASE outcome WHEN 'created' THEN 'active' WHEN 'disabled' THEN 'disabled' ELSE status END,
           CASE outcome WHEN 'created' THEN 1 WHEN 'updated' THEN v + 1 WHEN 'disabled' THEN v + 1 WHEN 'reassigned' THEN v + 1 ELSE v END, busy
    FROM (
        SELECT n.ext, n.k, n.no, company, f.owner, f.status, f.v, f.busy,
               CASE WHEN action <> 'register' AND NOT reasoned THEN 'no_reason'
                    WHEN action = 'register' THEN CASE WHEN f.v IS NULL THEN 'created' WHEN f.owner = company THEN 'updated' ELSE 'owner_differs' END
                    WHEN f.v IS NULL THEN 'unknown_source' WHEN f.owner <> expected THEN 'owner_differs' WHEN expected_v <> f.v THEN 'version_differs' WHEN f.busy THEN 'runs_in_progress'
                    WHEN action = 'disable' THEN CASE WHEN f.status = 'disabled' THEN 'already_disabled' ELSE 'disabled' END
                    WHEN company = 9999 THEN 'unknown_target' WHEN company = f.owner THEN 'same_owner' ELSE 'reassigned' END AS outcome
        FROM f JOIN numbered n ON n.ext = f.ext AND n.k = f.k + 1
    )
)
SELECT no AS request_no, ext AS external_id, outcome, owner AS company_after, status AS status_after, v AS version_after FROM f WHERE k > 0
""")
def source_requests(spark, sf):
    k = F.col("s_suppkey")
    stored = load(spark, sf, "supplier").select(
        k.alias("source_id"), (k % 50 + 1).alias("company_id"), F.lit("board").alias("provider"), F.concat(F.lit("b"), k).alias("external_id"), F.lit("board").alias("source_kind"), F.lit(None).cast("string").alias("source_url"),
        F.lit("complete_snapshot").alias("sync_mode"), F.when(k % 9 == 0, "disabled").otherwise("active").alias("status"), F.lit(1).cast("long").alias("version")
    )
    o, c = F.col("o_orderkey"), F.col("o_custkey") % 130
    requests = load(spark, sf, "orders").select(
        o.alias("request_no"),
        F.when(o % 4 == 0, "register").when(o % 4 == 1, "disable").otherwise("reassign").alias("action"),
        F.lit(" Board ").alias("provider"),
        F.concat(F.lit("b"), c, F.lit(" ")).alias("external_id"),
        F.when(o % 4 == 0, c % 50 + 1).when(o % 23 == 2, F.lit(9999).cast("long")).otherwise(o % 50 + 1).alias("company_id"),
        F.when(o % 3 == 0, c % 50 + 1).otherwise((o + 43) % 50 + 1).alias("expected_company_id"),
        F.when(o % 5 == 0, o % 4 + 1).alias("expected_version"),
        F.lit("board").alias("source_kind"),
        F.lit(None).cast("string").alias("source_url"),
        F.lit("complete_snapshot").alias("sync_mode"),
        F.when(o % 29 != 0, "moved by its owner").alias("reason"),
    )
    companies = spark.range(1, 51).withColumnRenamed("id", "company_id")
    _, outcomes = registry.apply_requests(stored, requests, companies, stored.where("source_id % 17 = 0"))
    return outcomes.select("request_no", "external_id", "outcome", "company_after", "status_after", "version_after")


@query("""
WITH lease AS (
    SELECT c_custkey AS c, 'b' || (c_custkey % 1400) AS board, c_custkey % 1400 AS b,
           CASE WHEN c_custkey % 11 = 0 THEN 2 WHEN c_custkey % 13 = 0 THEN 1 WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS asserted, CASE WHEN c_custkey % 13 = 0 THEN 999999 ELSE c_custkey % 10 + 1 END AS wanted
    FROM customer
), posting AS (
    SELECT o_custkey AS c, CASE WHEN o_custkey % 29 = 0 THEN 'x' ELSE CAST(o_orderkey AS VARCHAR) END AS ext, CASE WHEN o_custkey % 2 = 0 THEN 'Name ' || o_custkey ELSE 'Name ' || (o_orderkey % 2) END AS name FROM orders
), per AS (
    SELECT c, count(*) AS n, count(*) > count(DISTINCT ext) AS faulty, count(DISTINCT lower(name)) AS names FROM posting GROUP BY c
), known AS (
    SELECT s_suppkey AS id, CASE WHEN s_suppkey % 7 = 0 THEN 'disabled' ELSE 'active' END AS status FROM supplier WHERE s_suppkey % 3 <> 0
), judged AS (
    SELECT lease.*, coalesce(n, 0) AS n, known.id AS source,
           CASE WHEN c % 37 = 0 THEN 'incomplete_source_evidence' WHEN asserted = 2 THEN 'ambiguous_company_identity' WHEN c % 17 = 0 THEN 'no_snapshot' WHEN status = 'disabled' THEN 'source_not_open'
                WHEN c % 19 = 0 OR c % 23 = 0 OR coalesce(faulty, false) THEN CASE WHEN (c % 19 = 0 AND c % 2 = 0) OR c % 23 = 0 THEN 'incomplete_snapshot_for_now' ELSE 'incomplete_snapshot' END
                WHEN known.id IS NULL AND asserted = 1 AND wanted = 999999 THEN 'unknown_company' WHEN known.id IS NULL AND asserted = 0 AND coalesce(names, 0) <> 1 THEN 'company_identity_required' ELSE 'promoted' END AS o
    FROM lease LEFT JOIN per USING (c) LEFT JOIN known ON known.id = b AND c % 37 <> 0
), done AS (
    SELECT *, CASE WHEN o = 'promoted' AND c > min(c) FILTER (o = 'promoted') OVER (PARTITION BY board) THEN 'waits' ELSE o END AS outcome FROM judged
), made AS (
    SELECT b, CASE WHEN asserted = 1 THEN wanted ELSE (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (PARTITION BY asserted = 0 ORDER BY c) END AS company,
           (SELECT max(id) FROM known) + row_number() OVER (ORDER BY c) AS id FROM done WHERE outcome = 'promoted' AND source IS NULL
), old AS (
    SELECT o_custkey AS b, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'gone ' || o_orderkey END AS ext, o_orderkey % 4 = 1 AS missed FROM orders JOIN known ON known.id = o_custkey
), jobs AS (
    SELECT b, count(*) FILTER (ext IN (SELECT ext FROM posting WHERE posting.c = done.c) OR NOT missed) AS stay, count(*) FILTER (ext IN (SELECT ext FROM posting WHERE posting.c = done.c)) AS again,
           count(*) AS n FROM old JOIN done USING (b) WHERE outcome = 'promoted' GROUP BY b
), before AS (
    SELECT b, count(*) AS n FROM old GROUP BY b
)
SELECT 'https://boards.example/' || lpad(CAST(c AS VARCHAR), 9, '0') AS normalized_url, outcome, coalesce(source, made.id) AS source_id, coalesce(source, company) AS company_id,
       CASE WHEN outcome = 'promoted' THEN 'done' ELSE 'promote' END AS stage,
       CASE WHEN outcome = 'promoted' THEN 'done' WHEN outcome = 'waits' THEN 'leased' WHEN outcome IN ('no_snapshot', 'source_not_open', 'incomplete_snapshot_for_now') THEN CASE WHEN c % 4 = 3 THEN 'dead' ELSE 'retry' END ELSE 'quarantined' END AS state,
       CASE WHEN outcome IN ('promoted', 'company_identity_required', 'incomplete_snapshot', 'incomplete_snapshot_for_now') THEN done.n ELSE 0 END AS candidates,
       CASE WHEN outcome = 'promoted' THEN done.n ELSE 0 END AS promoted_candidates,
       CASE WHEN coalesce(source, made.id) IS NULL THEN 0 WHEN p.o IS NULL THEN coalesce(before.n, 0) ELSE p.n + coalesce(jobs.stay - jobs.again, 0) END AS active_jobs
FROM done LEFT JOIN made ON made.b = done.b AND c % 37 <> 0 LEFT JOIN jobs ON jobs.b = done.b LEFT JOIN before ON before.b = done.b LEFT JOIN (SELECT b, o, n FROM done WHERE outcome = 'promoted') p ON p.b = done.b
""")
def promoted_boards(spark, sf):
    c, as_of = F.col("c_custkey"), "2024-02-01 00:00:00"
    none, text_none = F.lit(None).cast("long"), F.lit(None).cast("string")
    url = F.concat(F.lit("https://boards.example/"), F.lpad(c.cast("string"), 9, "0"))
    customers = load(spark, sf, "customer").withColumn("normalized_url", url)
    board = F.concat(F.lit("b"), c % 1400)
    asserted = F.when(c % 11 == 0, F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).when(c % 13 == 0, F.array(F.lit(999999).cast("long"))).when(c % 5 == 0, F.array(c % 10 + 1)).otherwise(F.array().cast("array<bigint>"))
    leases = customers.select(
        "normalized_url", F.lit(1).cast("long").alias("run_id"), F.concat(F.lit("t"), c).alias("lease_token"), F.when(c % 37 == 0, " ").otherwise("board").alias("provider"), board.alias("external_source_id"),
        url.alias("canonical_url"), asserted.alias("asserted_ids"), none.alias("proposed_company_id")
    )
    snapshots = customers.where(c % 17 != 0).select(
        "normalized_url", F.lit("board").alias("provider"), board.alias("external_source_id"), (c % 19 != 0).alias("is_complete"), F.when((c % 19 == 0) & (c % 2 == 0), 503).otherwise(200).alias("http_status"),
        F.when(c % 23 == 0, F.array(F.lit("ReadTimeout"))).otherwise(F.array().cast("array<string>")).alias("error_kinds")
    )
    orders, o, of = load(spark, sf, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    postings = orders.select(
        F.concat(F.lit("https://boards.example/"), F.lpad(of.cast("string"), 9, "0")).alias("normalized_url"),
        o.cast("int").alias("position"),
        F.when(of % 29 == 0, "x").otherwise(o.cast("string")).alias("external_job_id"),
        F.col("o_orderpriority").alias("title"),
        F.when(of % 2 == 0, F.concat(F.lit("Name "), of)).otherwise(F.concat(F.lit("Name "), o % 2)).alias("company_name"),
        F.col("o_orderstatus").alias("content_hash"),
        text_none.alias("location"),
        text_none.alias("posting_url"),
    )
    k = F.col("s_suppkey")
    suppliers = load(spark, sf, "supplier")
    sources = suppliers.where(k % 3 != 0).select(
        k.alias("source_id"), k.alias("company_id"), F.lit("board").alias("provider"), F.concat(F.lit("b"), k).alias("external_id"), F.lit("board").alias("source_kind"), text_none.alias("source_url"), F.lit("complete_snapshot").alias("sync_mode"),
        F.when(k % 7 == 0, "disabled").otherwise("active").alias("status"), F.lit(1).cast("long").alias("version")
    )
    companies = suppliers.select(k.alias("company_id"), F.col("s_name").alias("name"), F.lower("s_name").alias("normalized_name"), F.concat(F.lit("s"), k).alias("slug"), text_none.alias("website"), text_none.alias("primary_domain"), F.lit("verified").alias("identity_state"))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    jobs = orders.join(sources.select(F.col("source_id").alias("o_custkey")), "o_custkey").select(
        of.alias("source_id"), F.when(o % 2 == 0, o.cast("string")).otherwise(F.concat(F.lit("gone "), o)).alias("external_job_id"), F.lit("active").alias("status"), F.when(o % 4 == 1, 1).otherwise(0).alias("consecutive_misses"),
        F.lit("old").alias("content_hash"), *[at.alias(t) for t in ("first_seen_at", "last_seen_at", "last_changed_at")], F.lit(None).cast("timestamp").alias("closed_at"), F.lit("t").alias("title"), text_none.alias("location"), text_none.alias("posting_url")
    )
    expires = F.lit("2024-02-02 00:00:00").cast("timestamp")
    work = customers.select(
        "normalized_url", F.lit("promote").alias("stage"), F.lit("leased").alias("state"), F.lit(0).alias("priority"), F.when(c % 4 == 3, 4).otherwise(1).alias("attempt_count"), F.lit(4).alias("max_attempts"), at.alias("available_at"),
        F.lit("w").alias("lease_owner"), F.concat(F.lit("t"), c).alias("lease_token"), expires.alias("lease_expires_at"), text_none.alias("last_error")
    )
    assert work.columns == [w.split()[0] for w in staging.WORK.split(", ")]
    versions = Versions(spark, shared_folder(spark, "promotion"))
    versions.commit({"companies": companies, "sources": sources, "candidates": spark.createDataFrame([], promotion.CANDIDATES), "jobs": jobs, "work": work})
    promotion.run(versions, leases, snapshots, postings, as_of)
    now = versions.read()
    found = now["candidates"].groupBy("normalized_url").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("status") == "promoted").alias("promoted_candidates"))
    active = now["jobs"].where("status = 'active'").groupBy("source_id").agg(F.count(F.lit(1)).alias("active_jobs"))
    rows = now["decisions"].select("normalized_url", "outcome", "source_id", "company_id").join(now["work"].select("normalized_url", "stage", "state"), "normalized_url")
    return rows.join(found, "normalized_url", "left").join(active, "source_id", "left").fillna(0, ["candidates", "promoted_candidates", "active_jobs"])
