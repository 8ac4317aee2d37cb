"""Imports, evidence and links, applied to domain columns that are derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import times, urls
from millrace.operators import evidence, imports, roles
from millrace.sources.tables import load

from .domain import REMOTES
from .registry import query


@query("""
WITH b AS (
    SELECT page_id, lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) AS scheme, regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) AS site, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages
), d AS (SELECT *, concat(scheme, '://', site) AS root, CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END AS dir FROM b)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN concat(root, '/jobs/', page_id) WHEN 1 THEN concat(root, dir, 'view?id=', page_id) WHEN 2 THEN NULL WHEN 3 THEN concat('https://other.example.org/a?q=', page_id)
       WHEN 4 THEN concat(scheme, '://cdn.example.org/x') ELSE concat(root, CASE WHEN dir = '/' THEN '/' ELSE regexp_replace(dir, '[^/]+/$', '') END, 'up/', page_id) END AS link FROM d
""")
def resolved_hrefs(spark, sf):
    k = F.col("page_id")
    href = (
        F.when(k % 6 == 0, F.concat(F.lit(" /jobs/./"), k, F.lit("/")))
        .when(k % 6 == 1, F.concat(F.lit("view?id="), k, F.lit("#top")))
        .when(k % 6 == 2, "mailto:jobs@example.org")
        .when(k % 6 == 3, F.concat(F.lit("HTTPS://other.example.org/a;p=1?q="), k))
        .when(k % 6 == 4, "//cdn.example.org/x/")
        .otherwise(F.concat(F.lit("../up/"), k))
    )
    return load(spark, sf, "pages").select("page_id", urls.resolve_href(F.col("url"), href).alias("link"))


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id % 100 AS DOUBLE) WHEN 1 THEN CAST(greatest(0, (event_id % 50 - 10) * 60) AS DOUBLE) END AS wait_seconds FROM events
""")
def retry_after_seconds(spark, sf):
    k, at = F.col("event_id"), F.date_trunc("second", "ts").cast("timestamp_ntz")
    later = at + F.make_dt_interval(mins=(k % 50 - 10).cast("int"))
    value = F.when(k % 4 == 0, (k % 100).cast("string")).when(k % 4 == 1, F.date_format(later, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(k % 4 == 2, "soon")
    return load(spark, sf, "events").select("event_id", times.retry_after(value, at).alias("wait_seconds"))


@query("""
WITH t AS (SELECT doc_id, coalesce(lower(text), '') AS t FROM documents)
SELECT doc_id, CASE WHEN t LIKE '%open source%' OR t LIKE '%developer tools%' OR t LIKE '%infrastructure%' THEN 'Build a repo PR, SDK/plugin, or runnable integration demo with docs and a Loom.'
                    WHEN t LIKE '%security%' OR t LIKE '%compliance%' THEN 'Build an audit-trail workflow or security automation demo against a realistic sample app.'
                    WHEN t LIKE '%customer support%' OR t LIKE '%customer success%' THEN 'Build an AI triage/insights demo from sample support tickets and show before/after workflow time.'
                    WHEN t LIKE '%fintech%' OR t LIKE '%finance%' OR t LIKE '%payments%' THEN 'Build a reconciliation/risk dashboard with explainable flags and exportable audit evidence.'
                    WHEN t LIKE '%healthcare%' THEN 'Build a HIPAA-conscious intake/ops workflow demo using synthetic patient/provider data.'
                    WHEN t LIKE '%recruiting%' OR t LIKE '%human resources%' THEN 'Build a candidate/job matching or workflow automation prototype with transparent scoring.'
                    WHEN t LIKE '%ai%' OR t LIKE '%agent%' THEN 'Build a focused AI agent demo that automates one painful user workflow end to end.'
                    ELSE 'Build a narrow workflow prototype tied to their one-liner, with a 60-second Loom and repo.' END AS angle FROM t
""")
def prototype_angles(spark, sf):
    return load(spark, sf, "documents").select("doc_id", evidence.prototype_angle(F.lower("text")).alias("angle"))


@query("""
WITH r AS (
    SELECT s_suppkey, [concat('{"location":"', s_nationkey, '","name":"', s_name, '"}'), CASE WHEN s_suppkey % 2 = 0 THEN concat('{"name":"', s_name, '"}') END,
           CASE WHEN s_suppkey % 3 = 0 THEN concat('{"location":"', s_nationkey, '"}') ELSE concat('{"location":"', s_nationkey, '","name":"', s_name, '"}') END] AS offices FROM supplier
)
SELECT s_suppkey, array_to_string(list_sort(list_distinct(offices)), ' ') AS offices FROM r
""")
def canonical_offices(spark, sf):
    key, name, nation = F.col("s_suppkey"), F.col("s_name"), F.col("s_nationkey").cast("string")

    def office(name, location):
        return F.struct(name.alias("name"), location.alias("location"))

    offices = F.array(office(F.concat(F.lit(" "), name), nation), office(F.when(key % 2 == 0, name), F.lit(" ")), office(F.when(key % 3 != 0, name), nation))
    return load(spark, sf, "supplier").select("s_suppkey", F.array_join(evidence.canonical_records(offices, ["name", "location"]), " ").alias("offices"))


@query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN concat('N', c_nationkey, ',Peru') WHEN 1 THEN CASE WHEN c_custkey % 2 = 0 THEN concat('Chile,N', c_nationkey) ELSE 'Chile' END ELSE '' END AS countries FROM customer
""")
def metadata_countries(spark, sf):
    key, nation = F.col("c_custkey"), F.concat(F.lit("N"), F.col("c_nationkey"))

    def field(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    metadata = F.array(
        field("Team", F.lit("Peru")),
        field(" Hiring Countries", F.when(key % 3 == 0, F.concat(nation, F.lit(" ; Peru|"), F.lower(nation))).when(key % 3 == 1, '["Chile", null, "chile, CHILE"]')),
        field("country", F.when((key % 3 == 1) & (key % 2 == 0), nation)),
    )
    return load(spark, sf, "customer").select("c_custkey", F.array_join(evidence.metadata_countries(metadata), ",").alias("countries"))


@query("SELECT s_suppkey, concat_ws(' ', s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'remote' END, s_nationkey, 'a', CASE WHEN s_suppkey % 3 = 0 THEN 'b' END) AS context FROM supplier")
def job_contexts(spark, sf):
    key = F.col("s_suppkey")
    fields = [F.col("s_name"), F.when(key % 2 == 0, "remote").otherwise(""), F.when(key < 0, "none"), F.col("s_nationkey").cast("string")]
    skills = F.array_compact(F.array(F.lit("a"), F.when(key % 3 == 0, "b")))
    return load(spark, sf, "supplier").select("s_suppkey", evidence.job_context(fields, skills).alias("context"))


@query("SELECT l_suppkey AS run_id, o_orderstatus AS state, count(DISTINCT o_orderkey) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2")
def run_work_states(spark, sf):
    observations = load(spark, sf, "lineitem").select(F.col("l_suppkey").alias("run_id"), F.col("l_orderkey").alias("work_id"))
    return imports.run_states(observations, load(spark, sf, "orders").select(F.col("o_orderkey").alias("work_id"), F.col("o_orderstatus").alias("state")))


@query("""
WITH j AS (SELECT l_suppkey, l_partkey, min(l_orderkey) AS job FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, CASE WHEN job IS NOT NULL AND l.l_returnflag = 'N' THEN 'promoted' ELSE 'candidate' END AS status, CASE WHEN l.l_returnflag = 'N' THEN job END AS promoted_job_id
FROM lineitem l LEFT JOIN j ON j.l_suppkey = l.l_suppkey AND j.l_partkey = l.l_partkey
""")
def promoted_candidates(spark, sf):
    source, job = F.col("l_suppkey").alias("company_source_id"), F.col("l_partkey").alias("external_job_id")
    lines = load(spark, sf, "lineitem")
    candidates = lines.select("l_orderkey", "l_linenumber", "l_returnflag", source, job, F.lit("candidate").alias("status"), F.lit(None).cast("long").alias("promoted_job_id"))
    jobs = lines.where("l_returnflag = 'R'").groupBy(source, job).agg(F.min("l_orderkey").alias("job_id"))
    return imports.mark_promoted(candidates, jobs, F.col("l_returnflag") == "N").select("l_orderkey", "l_linenumber", "status", "promoted_job_id")


@query("""
WITH o AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS jobs, count(*) FILTER (o_orderstatus = 'P') AS runs FROM orders GROUP BY 1)
SELECT c_custkey AS source_id, coalesce(jobs, 0) AS jobs, coalesce(runs, 0) AS sync_runs FROM customer LEFT JOIN o ON o_custkey = c_custkey
""")
def source_dependants(spark, sf):
    orders = load(spark, sf, "orders").select(F.col("o_custkey").alias("source_id"), "o_orderstatus")
    sources = load(spark, sf, "customer").select(F.col("c_custkey").alias("source_id"))
    return imports.source_dependants(sources, orders.where("o_orderstatus = 'O'"), orders.where("o_orderstatus = 'P'"))


@query("""
SELECT count(DISTINCT o_custkey) AS companies_resolved, count(DISTINCT CASE WHEN o_orderkey % 30 = 0 THEN o_custkey END) AS companies_created,
       count(DISTINCT CASE WHEN o_orderkey % 20 = 0 THEN o_custkey END) AS provisional_companies FROM orders
""")
def import_summary(spark, sf):
    key = F.col("o_orderkey")
    state = F.when(key % 20 == 0, "provisional").otherwise("verified")
    return imports.import_summary(load(spark, sf, "orders").select(F.col("o_custkey").alias("company_id"), (key % 30 == 0).alias("company_created"), state.alias("identity_state")))


@query("""
SELECT DISTINCT o_orderpriority AS title, o_custkey % 100 AS department FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal < 0 AND o_orderstatus <> 'F'
""")
def run_display_rows(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "closed").otherwise("active")
    jobs = load(spark, sf, "orders").select(F.col("o_custkey").alias("source_id"), F.col("o_orderpriority").alias("title"), (F.col("o_custkey") % 100).alias("department"), status.alias("status"))
    return imports.display_rows(jobs, ["title", "department"], load(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("source_id")))


TITLES = ("Senior Software Engineer", "Account Executive", "Backend Platform Engineer", "Full Stack Engineer", "Software Engineering Intern", "Data Analyst")


@query("""
WITH j AS (SELECT o_orderkey AS job, CASE o_orderkey % 6 WHEN 0 THEN 'strong' WHEN 2 THEN 'strong' WHEN 3 THEN 'possible' ELSE 'exclude' END AS role, o_orderkey % 7 AS r FROM orders)
SELECT job, role AS role_match_status, CASE r WHEN 0 THEN 'pakistan_explicit' ELSE 'global_explicit' END AS remote_eligibility_status FROM j WHERE role <> 'exclude' AND r < 2
""")
def matching_postings(spark, sf):
    key = F.col("o_orderkey")

    def pick(values):
        return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))

    jobs = load(spark, sf, "orders").select(key.alias("job"), pick(TITLES).alias("title"), pick(REMOTES).alias("remote"))
    gate = roles.any_signal(F.lower("title"), ("engineer", "developer"))
    rows = imports.matching(jobs, roles.classify_role(F.col("title"))["status"], F.col("remote"), ["strong", "possible"], ["pakistan_explicit", "global_explicit"], gate)
    return rows.select("job", "role_match_status", "remote_eligibility_status")
